"""Scans, documents, snapshots and ranges."""

from pyspark.sql import functions as F

from dayline.functions.dates import date_bounds, format_date, local_date, parse_date
from dayline.operators.filters import scan_between
from dayline.operators.joins import attach_lookup, union_all
from dayline.operators.spatial import scan_polygons
from dayline.queries import query
from dayline.queries.tables import SHAPES_SQL, order_days, supplier_shapes, table
from dayline.session import scratch_path
from dayline.sources import landed
from dayline.sources.documents import (explode_country_index, explode_events, html_rows,
                                       scan_stations, station_days)
from dayline.sources.files import scan, scan_csv, scan_json_array, scan_json_records
from dayline.sources.snapshots import latest_snapshot_per_day, scan_newest


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def customers_from_csv(spark, sf_dir):
    source = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer-csv")
    source.write.option("header", True).csv(path)
    return scan_csv(spark, path, source.schema)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def suppliers_from_json(spark, sf_dir):
    source = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "supplier-json")
    source.write.json(path)
    return scan_json_records(spark, path, source.schema, multi_line=False)


@query("""
    SELECT c_custkey, c_name || '}, {"a\\"' AS name, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS balance,
           c_nationkey AS nation, '{' || c_mktsegment AS segment FROM customer""")
def customers_from_one_json_array(spark, sf_dir):
    """One file of one array; strings hold braces, quotes and backslashes, and records are nested."""
    path = scratch_path(spark, "customer-array")
    place = F.struct(F.struct(F.col("c_nationkey").alias("nation")).alias("at"), F.concat(F.lit("{"), "c_mktsegment").alias("segment"))
    record = F.to_json(F.struct("c_custkey", F.concat("c_name", F.lit('}, {"a\\"')).alias("name"),
                                F.when(F.col("c_custkey") % 3 != 0, F.col("c_acctbal")).alias("balance"), place.alias("place")))
    customers = table(spark, sf_dir, "customer")
    lines = customers.select(F.concat(record, F.lit(",")).alias("value"))
    ends = spark.createDataFrame([("[", 0), ("{}]", 2)], "value string, part int")
    lines.withColumn("part", F.lit(1)).unionByName(ends).coalesce(1).sortWithinPartitions("part").select("value").write.text(path)
    rows = scan_json_array(spark, path, "c_custkey long, name string, balance double, place struct<at:struct<nation:long>,segment:string>")
    nation = F.col("place.at.nation").cast(customers.schema["c_nationkey"].dataType)
    return rows.filter("c_custkey IS NOT NULL").select("c_custkey", "name", "balance", nation.alias("nation"), "place.segment")


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def parts_stored_and_scanned(spark, sf_dir):
    path = scratch_path(spark, "part")
    table(spark, sf_dir, "part").write.parquet(path)
    return scan(spark, path)


@query("""
    SELECT CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS value
    FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1""")
def country_index_documents(spark, sf_dir):
    per_day = order_days(spark, sf_dir, "o_orderpriority")
    entry = F.struct(F.col("o_orderpriority"), F.struct(F.col("n").alias("stringency")))
    docs = per_day.groupBy("date").agg(F.map_from_entries(F.collect_list(entry)).alias("m")).select(
        F.to_json(F.struct(F.create_map(format_date("date"), F.col("m")).alias("data"))).alias("value"))
    errors = per_day.select(F.to_json(F.struct(F.lit("error").alias("status"),
                                               F.lit(404).alias("code"))).alias("value"))
    return explode_country_index(docs.unionByName(errors), "1-URGENT")


@query("""
    SELECT o_orderpriority AS holiday, CAST(o_orderdate AS DATE) AS "start",
           CAST(o_orderdate AS DATE) + 2 AS "end" FROM orders""")
def calendar_documents(spark, sf_dir):
    day = F.col("o_orderdate")
    item = F.struct(F.col("o_orderpriority").alias("summary"),
                    F.struct(format_date(day).alias("date")).alias("start"),
                    F.struct(format_date(F.date_add(day, 2)).alias("date")).alias("end"))
    docs = table(spark, sf_dir, "orders").select(
        F.to_json(F.struct(F.array(item).alias("items"))).alias("value"))
    return explode_events(docs)


@query("""
    SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS name,
           CAST(s_nationkey AS DOUBLE) AS lat, CAST(s_suppkey AS DOUBLE) AS lon, s_acctbal AS elev
    FROM supplier WHERE s_acctbal >= 1000""")
def active_station_feed(spark, sf_dir):
    record = F.struct(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("nome"),
        F.col("s_nationkey").alias("lat"), F.col("s_suppkey").alias("lon"),
        F.col("s_acctbal").alias("elev"), F.lit(0.0).alias("est"), F.lit(0.0).alias("nord"),
        F.when(F.col("s_acctbal") >= 1000, "").otherwise("31/12/2020").alias("fine"),
        F.lit("01/01/1990").alias("inizio"))
    docs = table(spark, sf_dir, "supplier").select(
        F.to_json(F.struct(F.array(record).alias("records"))).alias("value"))
    return scan_stations(docs)


@query(r"""
    WITH items AS (
        SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1)) AS item,
               generate_subscripts(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1), 1) - 1
               AS row FROM pages),
    cells AS (
        SELECT page_id, row, regexp_extract_all(item, '(?is)<a\b[^>]*>(.*?)</a\s*>', 1) AS c FROM items)
    SELECT page_id, CAST(row AS INTEGER) AS row, CAST(len(c) AS INTEGER) AS n_cells,
           trim(regexp_replace(c[1], '<[^>]*>', '', 'g')) AS first_cell FROM cells""")
def page_list_rows(spark, sf_dir):
    rows = html_rows(table(spark, sf_dir, "pages").select("page_id", "html"),
                     row_re=r"(?is)<li\b[^>]*>(.*?)</li\s*>",
                     cell_re=r"(?is)<a\b[^>]*>(.*?)</a\s*>", within_re=None)
    return rows.select("page_id", "row", F.size("cells").alias("n_cells"),
                       F.get("cells", F.lit(0)).alias("first_cell"))


@query("""
    SELECT event_id AS station_id, CAST(ts AS DATE) AS date,
           CASE WHEN event_type <> 'error' THEN value END AS temperature_mean,
           CAST(user_id AS DOUBLE) AS humidity_mean
    FROM events WHERE event_type <> 'signup'""")
def station_pages(spark, sf_dir):
    def row(*cells):
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells],
                        F.lit("</tr>"))

    text = F.lit
    measured = F.col("event_type") != "signup"
    page = F.concat(
        text("<html><table class='t'>"), row(text("Station"), text("x")),
        row(text("Type"), text("daily")),
        row(text("Date"), text("Umidita' aria (%)"), text("Temp. aria (°C)"), text("Quality")),
        row(text(""), text("mean"), text("mean"), text("")),
        row(F.concat(text("00:00:00 "), format_date("ts", "dd/MM/yyyy")),
            F.when(measured, F.col("user_id").cast("string")).otherwise(""),
            F.when(measured & (F.col("event_type") != "error"),
                   F.concat(text("<b>"), F.col("value").cast("string"), text("</b>"))).otherwise("-"),
            text("ok")),
        text("</table><table><tr><td>second</td></tr></table></html>"))
    pages = table(spark, sf_dir, "events").select(F.col("event_id").alias("station_id"),
                                                  page.alias("html"))
    return station_days(pages).select("station_id", "date", "temperature_mean", "humidity_mean")


@query("""
    SELECT CAST(l_shipdate AS DATE) AS day, l_returnflag, l_orderkey, l_linenumber, l_quantity
    FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
    QUALIFY l_orderkey = max(l_orderkey) OVER (PARTITION BY CAST(l_shipdate AS DATE), l_returnflag)""")
def newest_snapshot_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.to_date("l_shipdate").alias("day"), "l_returnflag", "l_orderkey", "l_linenumber",
        "l_quantity")
    return latest_snapshot_per_day(lines, "day", "l_orderkey", ["l_returnflag"],
                                   "1996-01-01", "2000-12-31")


@query("""
    SELECT s_suppkey, CASE WHEN s_suppkey % 3 <> 1 THEN s_name END AS s_name, s_nationkey,
           CASE WHEN s_suppkey % 3 <> 2 THEN s_acctbal END AS s_acctbal FROM supplier""")
def suppliers_from_csv_of_three_headers(spark, sf_dir):
    """One folder of files with all columns, with another order and one less, and with one less and one more."""
    source, path = table(spark, sf_dir, "supplier"), scratch_path(spark, "supplier-csv")
    third = F.col("s_suppkey") % 3
    for n, columns in enumerate((["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], ["s_acctbal", "s_nationkey", "s_suppkey"],
                                 ["s_nationkey", "s_suppkey", "'x' AS note", "s_name"])):
        source.filter(third == n).selectExpr(*columns).write.mode("append").option("header", True).csv(path)
    return scan_csv(spark, path, source.schema)


@query("""
    SELECT s_suppkey, CAST(n AS INTEGER) AS row, CASE n WHEN 0 THEN 'name' ELSE s_name END AS first_cell,
           CASE n WHEN 0 THEN 'nested' WHEN 1 THEN 'nation ' || s_nationkey || ' of 25 ≤ 25' ELSE 'none' END AS last_cell
    FROM supplier, range(3) t(n)""")
def rows_around_tables_in_cells(spark, sf_dir):
    """Pages whose first table has a table in a cell, with rows of its own."""
    inner = F.concat(F.lit("<table><tr><td>nation </td><td>"), F.col("s_nationkey").cast("string"), F.lit("</td></tr><tr><td> of 25 &le; 25</td></tr></table>"))
    page = F.concat(F.lit("<h1>x</h1><table><tr><th>name</th><th>nested</th></tr><tr><td>"), "s_name", F.lit("</td><td>"), inner,
                    F.lit("</td></tr><tr><td>"), "s_name", F.lit("</td><td>none</td></tr></table><table><tr><td>next</td></tr></table>"))
    rows = html_rows(table(spark, sf_dir, "supplier").select("s_suppkey", page.alias("html")))
    return rows.select("s_suppkey", "row", F.get("cells", F.lit(0)).alias("first_cell"), F.get("cells", F.lit(1)).alias("last_cell"))


@query("""
    WITH v AS (SELECT CAST(ts AS DATE) AS day, user_id % 7 AS version, * FROM events)
    SELECT day, CAST(version AS VARCHAR) AS version, event_id, user_id, event_type, value FROM v
    WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'
    QUALIFY version = max(version) OVER (PARTITION BY day)""")
def newest_landed_files(spark, sf_dir):
    """Seven versions of each day as files; only those of the newest are read."""
    path = scratch_path(spark, "history")
    events = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), (F.col("user_id") % 7).alias("version"), "event_id", "user_id", "event_type", "value")
    events.repartition("day", "version").write.partitionBy("day", "version").option("header", True).csv(path)
    rows = scan_newest(spark, path, "event_id long, user_id long, event_type string, value double", lo="2024-01-03", hi="2024-01-28",
                       day=r"day=([^/]+)/", version=r"version=([^/]+)/", header=True)
    return rows.withColumnsRenamed({"_day": "day", "_version": "version"})


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31'""")
def orders_in_closed_range(spark, sf_dir):
    return scan_between(table(spark, sf_dir, "orders"), "o_orderdate", "1997-01-01", "1998-12-31") \
        .select("o_orderkey", "o_totalprice")


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate > TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31'""")
def orders_in_half_open_range(spark, sf_dir):
    return scan_between(table(spark, sf_dir, "orders"), "o_orderdate", "1997-01-01", "1998-12-31",
                        lo_open=True).select("o_orderkey", "o_totalprice")


@query("""
    SELECT o_orderkey FROM orders
    WHERE o_orderdate >= DATE '2020-02-23' - INTERVAL 8000 DAY AND o_orderdate <= DATE '1999-12-31'""")
def orders_within_default_bounds(spark, sf_dir):
    low, high = date_bounds(None, "1999-12-31")
    orders = table(spark, sf_dir, "orders")
    return orders.filter((F.to_date("o_orderdate") >= F.date_sub(low, 8000))
                         & (F.to_date("o_orderdate") <= high)).select("o_orderkey")


@query("""
    WITH people AS (SELECT c_nationkey AS n_nationkey, count(*) AS population FROM customer GROUP BY 1)
    SELECT n_nationkey, n_name, population FROM nation LEFT JOIN people USING (n_nationkey)""")
def nation_populations(spark, sf_dir):
    people = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")) \
        .agg(F.count(F.lit(1)).alias("population"))
    return attach_lookup(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), people,
                         ["n_nationkey"], ["population"])


@query(f"""
    WITH {SHAPES_SQL}
    SELECT shapes.* FROM shapes JOIN supplier ON s_suppkey = poly_id JOIN nation ON n_nationkey = s_nationkey WHERE n_name = 'NATION_7'""")
def polygons_of_one_nation(spark, sf_dir):
    units = (table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "poly_id")
             .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")))
    return scan_polygons(supplier_shapes(spark, sf_dir), units, {"n_name": "NATION_7"}, "poly_id")


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed, CAST(o_orderdate AS DATE) AS parsed_short,
           strftime(o_orderdate, '%d/%m/%Y') AS written, CAST(NULL AS DATE) AS unparsed
    FROM orders""")
def dates_parsed_and_written(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    long_text = format_date("o_orderdate", "dd/MM/yyyy")
    # two-digit years fall into 2000-2099
    short_text = F.when(F.year("o_orderdate") >= 2000, format_date("o_orderdate", "dd/MM/yy")) \
        .otherwise(long_text)
    return orders.select("o_orderkey", parse_date(long_text).alias("parsed"),
                         parse_date(short_text).alias("parsed_short"), long_text.alias("written"),
                         parse_date(F.concat(F.lit("x"), long_text)).alias("unparsed"))


@query("""
    SELECT event_id, CAST(timezone('Europe/Vatican', timezone('UTC', ts)) AS DATE) AS day
    FROM events""")
def local_calendar_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", local_date(F.col("ts").cast("timestamp")).alias("day"))


@query("""
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
           CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS o_orderpriority
    FROM orders""")
def union_of_versions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return union_all(
        orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_totalprice"),
        orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        orders.filter("o_orderstatus NOT IN ('F', 'O')").select("o_orderkey", "o_orderstatus"))


@query("""
    SELECT CAST(o_orderdate AS DATE) AS date, 'P1' AS name, CAST(o_orderkey AS INTEGER) AS cases,
           CAST(o_custkey AS INTEGER) AS deaths, CAST(NULL AS INTEGER) AS active FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '2000-12-31'""")
def landed_status_rows(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        format_date("o_orderdate", "dd/MM/yyyy").alias("giorno"),
        F.col("o_orderkey").cast("string").alias("totale_pos"),
        F.col("o_custkey").cast("string").alias("deceduti"), F.lit("n/a").alias("pos_att"),
        F.lit("1").alias("nuovi"))
    return landed.province_data(raw, "P1", "1996-01-01", "2000-12-31") \
        .select("date", "name", "cases", "deaths", "active")


@query("""
    WITH v AS (SELECT CAST(ts AS DATE) AS day, user_id // 10 AS version, * FROM events)
    SELECT day AS date, CAST(user_id AS SMALLINT) AS code, CAST(event_id AS INTEGER) AS cases FROM v
    WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'
    QUALIFY version = max(version) OVER (PARTITION BY day)""")
def landed_town_versions(spark, sf_dir):
    raw = table(spark, sf_dir, "events").select(
        "ts", F.floor(F.col("user_id") / 10).alias("version"),
        F.when(F.col("event_type") == "view", format_date("ts", "dd/MM/yy"))
        .otherwise(format_date("ts", "dd/MM/yyyy")).alias("aggiornamento"),
        F.col("user_id").alias("codice"), F.col("event_type").alias("nome"),
        F.col("event_id").alias("contagi"))
    return landed.municipality_data(raw, "version", "ts", "2024-01-03", "2024-01-28") \
        .select("date", "code", "cases")


@query("""
    SELECT CAST(o_orderdate AS DATE) AS date,
           CASE o_orderstatus WHEN 'F' THEN 'finished' ELSE 'open' END AS region,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'red' WHEN '2-HIGH' THEN 'orange' END AS risk
    FROM orders WHERE o_orderstatus IN ('F', 'O')
      AND o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '2000-12-31'""")
def landed_risk_rows(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        format_date("o_orderdate").alias("data"), F.col("o_orderstatus").alias("denominazione_regione"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "rosso")
        .when(F.col("o_orderpriority") == "2-HIGH", "arancione").otherwise("viola").alias("colore"))
    return landed.region_risk(raw, "1996-01-01", "2000-12-31", {"F": "finished", "O": "open"},
                              only_named=True, lo_open=True)


@query("""
    SELECT CAST(l_shipdate AS DATE) AS date, CASE l_returnflag WHEN 'A' THEN 'north' ELSE l_returnflag END
           AS region, l_linestatus AS supplier, CAST(l_quantity AS INTEGER) AS n_doses FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01'""")
def landed_deliveries(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("area"), F.col("l_linestatus").alias("fornitore"),
        format_date("l_shipdate").alias("data_consegna"), F.col("l_quantity").alias("numero_dosi"),
        F.lit("x").alias("codice_NUTS1"))
    return landed.vaccines_delivery(raw, "1997-01-01", names={"A": "north"})


@query("""
    SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS region, l_linestatus AS supplier,
           p_size || '-' || (p_size + 9) AS age_group, CAST(l_quantity AS INTEGER) AS male,
           CAST(0 AS INTEGER) AS female, CAST(l_linenumber AS INTEGER) AS first_dose,
           CAST(l_linenumber + 1 AS INTEGER) AS second_dose
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R'
      AND l_shipdate <= TIMESTAMP '1999-12-31'""")
def landed_administrations(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("l_returnflag").alias("area"), F.col("l_linestatus").alias("fornitore"),
        format_date("l_shipdate").alias("data_somministrazione"),
        F.concat_ws("-", F.col("p_size"), F.col("p_size") + 9).alias("fascia_anagrafica"),
        F.col("l_quantity").alias("sesso_maschile"), F.lit(0).alias("sesso_femminile"),
        F.col("l_linenumber").alias("prima_dose"), (F.col("l_linenumber") + 1).alias("seconda_dose"))
    return landed.vaccines_administration(raw, "1990-01-01", "1999-12-31", {"R": "R"}, only_named=True)
