import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayline.llm import bpe
from dayline.llm.queries import op12_bpe
from dayline.llm.text import pack, pack_words, unpack, unpack_words
from tests.llm.cases import documents, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["<|endoftext|>", "a<|endoftext|>b", "  <|endoftext|>  x", "!!<|endoftext|><|endoftext|>!", "<|endoftext", "I'll we've 's 'S '",
       "a  b   c\t\td \n\n e\r\n", "   ", " \u00a0\u2003x", "\u0085\u0085y", "x\u3000\u3000", "12 345\u0662\u00bd x2y", "caf\u00e9 na\u00efve e\u0301 \u0928\u093f",
       "\u6f22\u5b57\u3002\u304b\u306a", "\U0001f600\U0001f468\u200d\U0001f469 \U0001f1e9\U0001f1ea", "\U00031350 x\u0870\u0871 \U0001e4f0\U0001e4f1!", "a\x00b\x01 \x7f",
       "?'s ''s 'll'", "-" * 9000, "x" * 7000, " " * 6000 + "y", "\n" * 3000, "\ufffd\ufeffz", "\u0d4d\u200c", "'\u0870's", "\uffff \ue000"]


def corpus():
    rng = random.Random(2)
    signs = [chr(i) for i in (*range(9, 14), *range(32, 127), 0x85, 0xa0, 0xb2, 0xe9, 0x301, 0x2003, 0x3000, 0x4e00, 0x870, 0x1f600)]
    mixed = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    return documents() + [(1000 + i, x, "en", "a", 0) for i, x in enumerate(ODD + mixed)]


def plain(rows):
    tokenizer = Tokenizer.from_file(PATH)
    out = []
    for doc, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        out.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_against_the_library(spark, tmp_path):
    rows = corpus()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, op12_bpe(spark, str(tmp_path)).collect()), key=repr) == plain(rows)


def test_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_BYTES", 300)
    monkeypatch.setattr(bpe, "PART_BYTES", 9000)
    rows = corpus()
    docs = frame(spark, rows).repartition(3).withColumnsRenamed({"lang": "chunk", "source": "word", "n_chars": "codes"})
    got = bpe.encode(docs, PATH, ["doc_id", "chunk", "word", "codes"])
    tokenizer = Tokenizer.from_file(PATH)
    want = [(d, lang, source, n, tokenizer.encode(t or "", add_special_tokens=False).ids) for d, t, lang, source, n in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_words_go_to_python_in_small_batches(spark, monkeypatch, tmp_path):
    """No batch of words is larger than ``BATCH_ROWS``, and the session keeps its own setting."""
    monkeypatch.setattr(bpe, "BATCH_ROWS", 7)
    seen = f"{tmp_path}/seen"

    class Noting:
        def __init__(self, df):
            self.df, self.sparkSession = df, df.sparkSession

        @property
        def write(self):
            def note(batches):
                for b in batches:
                    with open(seen, "a") as f:
                        f.write(f"{b.num_rows}\n")
                    yield b
            return self.df.mapInArrow(note, self.df.schema).write

    monkeypatch.setattr(bpe, "_by_chunk", lambda df, buckets, own=bpe._by_chunk: own(Noting(df), buckets))
    before = spark.conf.get(bpe.ARROW_ROWS)
    rows = [(i, f"text {i} of words", "en", "a", 0) for i in range(100)]
    got = bpe.encode(frame(spark, rows).coalesce(1), PATH, ["doc_id"])
    assert got.count() == 100 and spark.conf.get(bpe.ARROW_ROWS) == before
    sizes = [int(x) for x in open(seen)]
    assert sum(sizes) > 100 and max(sizes) <= 7


def test_each_word_is_encoded_once(spark, tmp_path):
    """Rows of one part hold a word several times; the tokenizer sees it once."""
    lists = [(1, 0, [" cat", "the"]), (2, 0, [" cat", " dog", "the"]), (3, 1, ["!"])]
    rows = [(c, p, bytearray(pack(pack_words(pa.array(w, pa.string()))))) for c, p, w in lists]
    tokenizer = Tokenizer.from_file(PATH)

    class Counting(bpe.Vocabulary):
        def tokenizer(self):
            class Noted:
                def encode_batch(_, words, **more):
                    with open(f"{tmp_path}/seen", "a") as f:
                        f.writelines(f"{w!r}\n" for w in words)
                    return super(Counting, self).tokenizer().encode_batch(words, **more)
            return Noted()
    got = bpe.encoded_words(spark.createDataFrame(rows, "chunk long, part int, data binary"), Counting(PATH)).collect()
    want = {c: [i for x in w for i in tokenizer.encode(x, add_special_tokens=False).ids] for c, _, w in lists}
    assert {r.list: unpack(bytes(r.ids))[1].tolist() for r in got} == want
    assert sorted(open(f"{tmp_path}/seen").read().splitlines()) == sorted(map(repr, [" cat", "the", " dog", "!"]))


def test_packed_arrays():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 1 << b, n) for b, n in ((8, 5), (17, 1000), (31, 7), (40, 9), (3, 0), (62, 4))]
    assert [x.tolist() for x in unpack(pack(arrays))] == [x.tolist() for x in arrays]
    words = pa.array([b"", b"a", "\u00e9".encode(), b"\x00x"], pa.binary())
    assert unpack_words(*unpack(pack(pack_words(words)))).to_pylist() == words.to_pylist()


def test_characters_that_the_jvm_splits_otherwise_are_unknown_to_it(spark):
    """Every code point alone beside a letter, a digit, a sign and a blank."""
    signs = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{x}a 1{x}1 !{x}! {x}  {x}" for x in signs[i:i + 64]) for i in range(0, len(signs), 64)]
    vocabulary = bpe.Vocabulary(PATH)
    got = spark.createDataFrame([(x,) for x in texts], "text string").select("text", bpe.words(F.col("text"), vocabulary).alias("w")).collect()
    known = [r for r in got if r.w is not None]
    assert len(known) > 2000
    for r in known:
        assert r.w == bpe.words_by_tokenizer(r.text, vocabulary)


def test_decode(spark):
    tokenizer = Tokenizer.from_file(PATH)
    rows = [(1, [50256, 0, 447, 447]), (2, []), (3, None), (4, [464, 3797, 99999, -1, 50256]), (None, [127, 128])]
    got = {r.k: r.text for r in bpe.decode(spark.createDataFrame(rows, "k int, ids array<int>"), PATH).collect()}
    for k, ids in rows:
        want = None if ids is None else tokenizer.decode([i for i in ids if 0 <= i <= 50256], skip_special_tokens=False)
        assert got[k] == want


def test_empty(spark):
    assert bpe.decode(bpe.encode(frame(spark, []), PATH, ["doc_id"]), PATH).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
