"""Scalar functions: strings, dates, numbers, arrays, maps and JSON; all built in, so whole stages are compiled."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.plans.catalog import query
from quernstone.sources.tables import table


@query("""
    SELECT p_partkey, lower(p_name) AS low, reverse(p_name) AS back, lpad(CAST(p_size AS VARCHAR), 5, '0') AS padded, rpad(p_brand, 12, '.') AS dotted, trim('  ' || p_name || ' ') AS trimmed, split_part(p_name, ' ', 1) AS first_word,
    CAST(len(string_split(p_name, ' ')) AS INT) AS words, regexp_replace(p_name, '[aeiou]', '*', 'g') AS masked, regexp_extract(p_brand, '([0-9]+)', 1) AS number, CAST(levenshtein(p_type, 'STANDARD') AS INT) AS distance,
    CAST(instr(p_name, 'e') AS INT) AS place, replace(p_brand, 'Brand', 'B') AS brand, repeat('ab', 2) AS twice, starts_with(p_name, 'a') AS with_a, concat_ws('-', p_brand, p_type) AS joined, translate(p_name, 'abc', 'xyz') AS turned,
    md5(p_name) AS digest, substr(p_name, 2, 4) AS middle, right(p_brand, 2) AS ending FROM part""")
def part_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, brand = F.col("p_name"), F.col("p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.lower(name).alias("low"), F.reverse(name).alias("back"), F.lpad(F.col("p_size").cast("string"), 5, "0").alias("padded"), F.rpad(brand, 12, ".").alias("dotted"), F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first_word"), F.size(F.split(name, " ")).alias("words"), F.regexp_replace(name, "[aeiou]", "*").alias("masked"), F.regexp_extract(brand, "([0-9]+)", 1).alias("number"),
        F.levenshtein("p_type", F.lit("STANDARD")).alias("distance"), F.instr(name, "e").alias("place"), F.replace(brand, F.lit("Brand"), F.lit("B")).alias("brand"), F.repeat(F.lit("ab"), 2).alias("twice"), name.startswith("a").alias("with_a"),
        F.concat_ws("-", brand, "p_type").alias("joined"), F.translate(name, "abc", "xyz").alias("turned"), F.md5(name.cast("binary")).alias("digest"), F.substring(name, 2, 4).alias("middle"), F.right(brand, F.lit(2)).alias("ending"),
    )


@query("""
    SELECT o_orderkey, CAST(date_diff('day', o_orderdate, TIMESTAMP '2000-01-01') AS INT) AS days, CAST(o_orderdate + INTERVAL 2 MONTH AS DATE) AS later, CAST(dayofweek(o_orderdate) + 1 AS INT) AS weekday, CAST(weekofyear(o_orderdate) AS INT) AS week,
    CAST(quarter(o_orderdate) AS INT) AS quarter, last_day(o_orderdate) AS month_end, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, strftime(o_orderdate, '%Y/%m/%d') AS written, CAST(dayofyear(o_orderdate) AS INT) AS day,
    CAST(epoch(o_orderdate) AS BIGINT) AS seconds, CAST(strptime('2001-02-03', '%Y-%m-%d') AS DATE) AS parsed, CAST(o_orderdate + INTERVAL 10 DAY AS DATE) AS tenth, make_date(CAST(year(o_orderdate) AS BIGINT), 1, 1) AS new_year FROM orders""")
def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("o_orderdate")
    day = at.cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.datediff(F.to_date(F.lit("2000-01-01")), day).alias("days"), F.add_months(day, 2).alias("later"), F.dayofweek(day).alias("weekday"), F.weekofyear(day).alias("week"), F.quarter(day).alias("quarter"), F.last_day(day).alias("month_end"),
        F.trunc(day, "month").alias("month"), F.date_format(at, "yyyy/MM/dd").alias("written"), F.dayofyear(day).alias("day"), F.unix_timestamp(at.cast("timestamp")).alias("seconds"), F.to_date(F.lit("2001-02-03"), "yyyy-MM-dd").alias("parsed"),
        F.date_add(day, 10).alias("tenth"), F.make_date(F.year(day), F.lit(1), F.lit(1)).alias("new_year"),
    )


@query("""
    SELECT p_partkey, round(p_retailprice, 1) AS rounded, CAST(floor(p_retailprice) AS BIGINT) AS low, CAST(ceil(p_retailprice) AS BIGINT) AS high, round(sqrt(p_retailprice), 6) AS root, round(ln(p_retailprice), 6) AS natural, round(log10(p_retailprice), 6) AS decimal_log,
    round(pow(p_size, 2.0), 3) AS square, abs(p_size - 25) AS apart, CAST(sign(p_size - 25) AS DOUBLE) AS side, p_size % 7 AS rest, greatest(p_size, 20) AS most, least(p_size, 20) AS few, round(sin(p_size), 6) AS sine, round(exp(p_size / 50.0), 6) AS power, p_size & 7 AS bits,
    CASE WHEN p_size = 25 THEN NULL ELSE round(100.0 / (p_size - 25), 6) END AS shared, round(degrees(atan2(p_size, 10.0)), 6) AS angle, CAST(trunc(p_retailprice) AS BIGINT) AS whole FROM part""")
def part_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.round(price, 1).alias("rounded"), F.floor(price).alias("low"), F.ceil(price).alias("high"), F.round(F.sqrt(price), 6).alias("root"), F.round(F.ln(price), 6).alias("natural"), F.round(F.log10(price), 6).alias("decimal_log"),
        F.round(F.pow(size, F.lit(2.0)), 3).alias("square"), F.abs(size - 25).alias("apart"), F.signum(size - 25).alias("side"), (size % 7).alias("rest"), F.greatest(size, F.lit(20)).alias("most"), F.least(size, F.lit(20)).alias("few"),
        F.round(F.sin(size), 6).alias("sine"), F.round(F.exp(size / 50.0), 6).alias("power"), size.bitwiseAND(7).alias("bits"), F.round(F.try_divide(F.lit(100.0).cast("double"), size - 25), 6).alias("shared"),
        F.round(F.degrees(F.atan2(size.cast("double"), F.lit(10.0))), 6).alias("angle"), price.cast("long").alias("whole"),
    )


@query("""
    WITH t AS (SELECT vec_id, list_transform(embedding[1:8], lambda x: CAST(round(x * 100) AS INT)) AS v FROM embeddings)
    SELECT vec_id, list_sort(v) AS sorted, list_aggregate(v, 'max') AS most, CAST(list_sum(v) AS BIGINT) AS total, len(list_distinct(v)) = 8 AS all_distinct, list_contains(v, 0) AS has_zero, v[2:4] AS part, list_reverse(v) AS back, v[1] AS head,
    list_bool_or(list_transform(v, lambda x: x > 25)) AS some_large, list_concat(v[1:1], v[8:8]) AS ends FROM t""")
def vector_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 8), lambda x: F.round(x * F.lit(100).cast("float")).cast("int")).alias("v"))
    v = F.col("v")
    return rows.select(
        "vec_id", F.array_sort(v).alias("sorted"), F.array_max(v).alias("most"), F.aggregate(v, F.lit(0).cast("long"), lambda s, x: s + x).alias("total"), (F.size(F.array_distinct(v)) == 8).alias("all_distinct"), F.array_contains(v, 0).alias("has_zero"),
        F.slice(v, 2, 3).alias("part"), F.reverse(v).alias("back"), F.element_at(v, 1).alias("head"), F.exists(v, lambda x: x > 25).alias("some_large"), F.concat(F.slice(v, 1, 1), F.slice(v, 8, 1)).alias("ends"),
    )


@query("""
    SELECT word, CAST(place AS INT) AS place, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS word, unnest(generate_series(0, len(string_split(p_name, ' ')) - 1)) AS place FROM part) GROUP BY ALL""")
def name_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "part").select(F.posexplode(F.split("p_name", " ")).alias("place", "word"))
    return words.groupBy("word", "place").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT user_id, CAST(count(*) FILTER (event_type = 'click') AS BIGINT) AS clicks, string_agg(DISTINCT event_type, ',' ORDER BY event_type) FILTER (event_type <> 'error') AS kinds, count(DISTINCT event_type) AS n_kinds,
    CAST(count(*) FILTER (event_type IN ('click', 'view')) AS BIGINT) AS seen FROM events GROUP BY user_id""")
def event_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by type as a map of each user; counted before the map is made, so that it has few entries."""
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    maps = counts.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("by_type"))
    m = F.col("by_type")
    seen = F.map_filter(m, lambda k, _: k.isin("click", "view"))
    return maps.select(
        "user_id", F.coalesce(F.try_element_at(m, F.lit("click")), F.lit(0)).alias("clicks"), F.array_join(F.array_sort(F.map_keys(F.map_filter(m, lambda k, _: k != "error"))), ",").alias("kinds"),
        F.cardinality(m).cast("long").alias("n_kinds"), F.aggregate(F.map_values(seen), F.lit(0).cast("long"), lambda s, x: s + x).alias("seen"),
    )


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, '{"id":' || event_id || ',"k":' || json_extract_string(props, '$.k') || '}' AS written, json_valid(props) AS valid, CAST(len(json_keys(props)) AS INT) AS keys FROM events""")
def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = F.from_json("props", "k int")
    return table(spark, sf_dir, "events").select(
        "event_id", read["k"].alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), read["k"].alias("k"))).alias("written"), F.try_parse_json("props").isNotNull().alias("valid"), F.size(F.json_object_keys("props")).alias("keys")
    )
