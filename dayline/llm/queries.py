"""The operators of this folder as queries on the supplied tables."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from dayline.llm import bpe, decontamination, language, lines, lm, mixing, phrases, quality, repeats, rules, sharding, simhash, turns
from dayline.llm.text import table
from dayline.queries import query

# Words, sources with their weights, the level at which sources that are not full divide, and the
# cut in the order of MD5 keys, with plain window sums over whole sources.
MIX_SQL = """
    WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
                      CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 8)
                           AS BIGINT) AS k
               FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (SELECT *, [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] :: DOUBLE AS weight,
                 source_size * 2.0 :: DOUBLE AS most, sum(source_size) OVER () * 1.5 :: DOUBLE AS budget FROM s),
    l AS (SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
                                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
                                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
    t AS (SELECT source, source_size, least(most, coalesce(weight * (
              SELECT arg_min(level, most / weight) FROM l WHERE level <= most / weight), most)) AS target FROM l),
    p AS (SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS budget,
                 sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size AS ahead
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
                + greatest(0, least(size, budget % source_size - ahead)) END AS BIGINT) AS taken FROM p
"""


@query(MIX_SQL)
def op1_mixing(spark, sf_dir):
    """What the mix by source takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op2_quality_classifier(spark, sf_dir):
    """Perplexity in bits a byte and the verdict of each document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


LEAK_SQL = """
    WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
    b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM benchmark),
    g AS (SELECT DISTINCT item_id, least(10, len(words)) AS n, array_to_string(words[i:i + 9], ' ') AS gram
          FROM (SELECT *, unnest(generate_series(1, greatest(1, len(words) - 9))) AS i FROM b WHERE len(words) > 0)),
    lengths AS (SELECT DISTINCT n FROM g),
    dg AS (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS gram
           FROM (SELECT *, unnest(generate_series(1, len(words) - n + 1)) AS i FROM w, lengths)),
    hits AS (SELECT DISTINCT doc_id, i, dg.n, item_id FROM dg JOIN g ON dg.n = g.n AND dg.gram = g.gram),
    pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
    its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
    SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@query(LEAK_SQL)
def op4_decontamination(spark, sf_dir):
    """Words of each document inside windows of benchmark items."""
    found = decontamination.find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                       table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", decontamination.hit_words().alias("n_hit"),
                        F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
                        (F.size("hit_spans") > 0).alias("contaminated"))


@query()
def op6_simhash(spark, sf_dir):
    """Fingerprint and component of each document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


SHARD_SQL = """
    WITH RECURSIVE names AS (SELECT i, 'shard-' || i AS name FROM range(32) t(i)),
    prefs AS (SELECT list(CAST('0x' || substr(md5('first:' || name), 1, 8) AS BIGINT) % 4099 ORDER BY i) AS first,
                     list(CAST('0x' || substr(md5('step:' || name), 1, 8) AS BIGINT) % 4098 + 1 ORDER BY i) AS step FROM names),
    turns AS (SELECT 0 AS turn, CAST(NULL AS BIGINT) AS slot, CAST([] AS BIGINT[]) AS taken
              UNION ALL
              SELECT turn + 1, free, list_append(taken, free) FROM (
                  SELECT turn, taken, list_filter(
                      list_transform(range(4099), lambda j: (first[turn % 32 + 1] + j * step[turn % 32 + 1]) % 4099),
                      lambda x: NOT list_contains(taken, x))[1] AS free
                  FROM turns, prefs WHERE turn < 4099)),
    slots AS (SELECT slot, CAST((turn - 1) % 32 AS BIGINT) AS shard FROM turns WHERE turn > 0),
    d AS (SELECT doc_id, CAST('0x' || substr(md5('slot:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 4099 AS slot
          FROM documents)
    SELECT doc_id, slot, shard FROM d JOIN slots USING (slot)
"""


@query(SHARD_SQL)
def op7_sharding(spark, sf_dir):
    """Slot and shard of each document."""
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


RULES_SQL = """
    WITH d AS (SELECT doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
    g AS (SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram
          FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM w)),
    r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
          FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p
                FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM g) WHERE n > 1) GROUP BY doc_id),
    l AS (SELECT host, doc_id, text, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS n,
                 lower(regexp_replace(trim(regexp_replace(x, '[\\x20\\x09-\\x0D]+', ' ', 'g')), '[0-9]', '0', 'g')) AS line
          FROM (SELECT host, doc_id, text, unnest(lines) AS x FROM w)),
    c AS (SELECT host, line FROM l GROUP BY host, line HAVING count(DISTINCT text) > 10),
    lost AS (SELECT doc_id, sum(n) AS gone FROM l JOIN c USING (host, line) GROUP BY doc_id),
    m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
                 CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                 CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone, 0) AS gone
          FROM w LEFT JOIN r USING (doc_id) LEFT JOIN lost USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
           NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND gone <= 0.5 * n_words AS kept FROM m
"""


@query(RULES_SQL)
def op8_quality_rules(spark, sf_dir):
    """Counts within each document and the verdict of the rules."""
    found = rules.judge(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op5_language_id(spark, sf_dir):
    """The predicted language of each document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify(docs).select("doc_id", "held_out", "lang_pred", "score", "accepted")


@query()
def op3_repeats(spark, sf_dir):
    """What is removed of each document as repeated 100-byte strings."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op9_lm_scoring(spark, sf_dir):
    """Base and mixed log10 probability of each document."""
    found = lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query()
def op10_line_dedup(spark, sf_dir):
    """The lines of each document that repeat an earlier line of the corpus, with their classes."""
    found = lines.repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", "n_links", "removed_lines", "classes")


@query()
def op11_conversation_repair(spark, sf_dir):
    """Faults, cheapest edits and the hash of the repaired rows of each damaged conversation."""
    rows = turns.damaged(table(spark, sf_dir, "conversations"))
    gone = rows.groupBy("conv_id").agg(F.max("alive").alias("alive")).where(~F.col("alive"))
    return turns.audits(rows.where("alive"), gone)


@query()
def op12_bpe(spark, sf_dir):
    """Number and hash of the ids of each document, and the hash of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, ["doc_id"])
    return bpe.decode(encoded, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


PHRASES_SQL = """
    WITH d AS (SELECT coalesce(lang, 'und') AS lang,
                      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM d),
    totals AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
    g AS (SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
          FROM (SELECT lang, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i FROM w, (VALUES (1), (2), (3)) s(size))),
    f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY lang, size, phrase HAVING count(*) >= 10),
    c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1),
    cuts AS (SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS lhs, array_to_string(words[k + 1:], ' ') AS rhs
             FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM c)),
    scored AS (SELECT cuts.*, x.f AS l, y.f AS r,
                      CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
               FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lhs JOIN f y ON y.lang = cuts.lang AND y.phrase = rhs),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    longer AS (SELECT lang, phrase, max(a) AS most FROM (
                   SELECT lang, a, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase
                   FROM c WHERE size = 3) GROUP BY lang, phrase),
    kept AS (SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""


@query(PHRASES_SQL)
def op13_collocations(spark, sf_dir):
    """The phrases of each language whose words stand together most."""
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    """The documents that the corpus pipeline keeps, mixes and places."""
    return corpus_pipeline.run(spark, sf_dir)
