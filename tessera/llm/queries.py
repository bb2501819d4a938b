"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import abuse, encode, layout, leak, near_dup, pack, pair_quality, split_overlap
from tessera.session import materialize, table

#: White space as Python's strip and split see it.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"


def _split():
    return F.lower(F.regexp_replace("dataset_split", rf"^{WS}+|{WS}+$", ""))


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "response_records").select("row_index", _split().alias("split"), pack.record_length("prompt", "response").alias("length"))
    runs = table(spark, sf_dir, "response_configs").select("config_name", _split().alias("split"), "max_length")
    return pack.pack_records(records, runs)


def p1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run's sequences: the records, or pieces of longer ones, that each holds, and where."""
    return _packed(spark, sf_dir).drop("max_length")


def p1_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.fill_report(_packed(spark, sf_dir)).drop("max_length")


def p1_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run: records that the sequences hold, their words, and the longest piece."""
    packed = _packed(spark, sf_dir)
    return packed.groupBy("config_name").agg(F.countDistinct("row_index").alias("n_records"), F.sum("length").alias("n_words"), F.max("length").alias("longest"))


def p1_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per run: records that lie whole in one sequence, records that were cut, and breaches of the rules:
    sequences over the capacity or with a gap, cut records that would have fit, missing words."""
    df = table(spark, sf_dir, "response_records").select("row_index", pack.record_length("prompt", "response").alias("words"))
    packed = materialize(_packed(spark, sf_dir), "packed")
    sequences = packed.groupBy("config_name", "max_length", "sequence").agg(F.sum("length").alias("used"), F.max(F.col("place") + F.col("length")).alias("end"))
    bad = sequences.groupBy("config_name").agg(F.count_if((F.col("used") > F.col("max_length")) | (F.col("used") != F.col("end"))).alias("n_overfull"))
    rows = packed.groupBy("config_name", "max_length", "row_index").agg(F.count("*").alias("n"), F.sum("length").alias("placed")).join(df, "row_index")
    rows = rows.groupBy("config_name").agg(
        F.count_if(F.col("n") == 1).alias("n_whole"),
        F.count_if(F.col("n") > 1).alias("n_cut"),
        F.count_if(((F.col("n") > 1) & (F.col("words") <= F.col("max_length"))) | (F.col("placed") != F.col("words"))).alias("n_broken"),
    )
    return rows.join(bad, "config_name")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_corpus(table(spark, sf_dir, "documents"))


def p6_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, those without text, and those whose ids decode to their text again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = encode.decode_corpus(encode.encode_corpus(docs), text_col="back")
    same = F.coalesce("text", F.lit("")).eqNullSafe(F.col("back"))
    return docs.join(back, "doc_id").agg(
        F.count("*").alias("n_documents"),
        F.count_if(F.coalesce(F.length("text"), F.lit(0)) == 0).alias("n_empty"),
        F.count_if(same).alias("n_exact"),
    )


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).select("doc_id", "item_id")


def p7_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per leaked item: documents that hold it, longest stretch in words."""
    return leak.item_report(_leaks(spark, sf_dir)).select("item_id", "n_documents", "longest")


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with leaks, their texts without the leaked spans."""
    docs = table(spark, sf_dir, "documents")
    return leak.remove_leaks(docs, _leaks(spark, sf_dir))


def _layout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = None
    for name, fields, as_json in (
        ("response_records", ["prompt", "response"], False),
        ("preference_records", ["prompt", "chosen", "rejected"], False),
        ("raw_records", ["payload"], True),
    ):
        part = layout.canonical_rows(table(spark, sf_dir, name), "row_index", fields, as_json, name)
        rows = part if rows is None else rows.unionByName(part)
    return rows


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = layout.group_layout_copies(_layout_rows(spark, sf_dir)).where("rep <> row")
    return groups.select(F.col("tab").alias("record_table"), F.col("rep").alias("row_index_a"), F.col("row").alias("row_index_b"))


def p5_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record once, with the number of its copies."""
    return layout.copy_counts(_layout_rows(spark, sf_dir)).select(F.col("tab").alias("record_table"), F.col("rep").alias("row_index"), "n_copies")


def _near(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return near_dup.near_duplicates(table(spark, sf_dir, "response_records"), size=3, threshold=0.5)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.row_pairs(*_near(spark, sf_dir))


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its class of copies, its group and its class's links."""
    return near_dup.groups(*_near(spark, sf_dir)).withColumnRenamed("row", "row_index")


def _overlaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    held = F.when(_split().isin("validation", "test"), True).when(_split() == "train", False)
    return split_overlap.split_overlaps(table(spark, sf_dir, "response_records"), held, size=3, threshold=0.5)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = split_overlap.row_pairs(*_overlaps(spark, sf_dir))
    return pairs.select(F.least("train_row", "held_row").alias("row_index_a"), F.greatest("train_row", "held_row").alias("row_index_b"))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per held-out split and source: rows with a prompt, and those that train also has."""
    df = table(spark, sf_dir, "response_records")
    return split_overlap.overlap_report(*_overlaps(spark, sf_dir), df, "row_index", _split(), F.coalesce("source", F.lit("(none)")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {
        "response_records": (table(spark, sf_dir, "response_records"), "row_index", "prompt", ["response"]),
        "preference_records": (table(spark, sf_dir, "preference_records"), "row_index", "prompt", ["chosen", "rejected"]),
    }
    return pair_quality.pair_defects(spark, tables, table(spark, sf_dir, "documents"))


def p2_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defective answers by table, field and defect."""
    return p2_found(spark, sf_dir).groupBy("record_table", "field", "defect").agg(F.count("*").alias("n_answers"))


def _abuse_scores(spark: SparkSession, sf_dir: str, least: float) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights, bias = abuse.fit_labels(docs, table(spark, sf_dir, "labels"))
    return abuse.score_documents(docs, weights, bias, keep=("source",), least=least)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return abuse.found(_abuse_scores(spark, sf_dir, min(abuse.THRESHOLDS.values()))).select("doc_id", "category")


def p8_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's scores by category."""
    return _abuse_scores(spark, sf_dir, 0.0)


def p8_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: documents, and the share with language of each category."""
    return abuse.rates(_abuse_scores(spark, sf_dir, 0.0), "source")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[:1] == "p" and k[1:2].isdigit()}


#: Words as every query cuts them, white space as Python's split sees it, the cleaned split.
_WORDS = r"regexp_extract_all(lower(coalesce({c}, '')), '[\p{{L}}\p{{N}}]+')"
_SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
_CLEAN = rf"lower(regexp_replace({{c}}, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g'))".replace("{85}", "{{85}}").replace("{Z}", "{{Z}}")
_CANON = r"regexp_replace(lower(coalesce({c}, '')), '[^\p{{L}}\p{{N}}]+', '', 'g')"
#: Distinct runs of three words (s), sizes (z), and pairs of rows with their common runs (j), of rows in t(row_index, w).
_SIMILAR = """
    s AS (SELECT DISTINCT row_index, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS run
          FROM (SELECT row_index, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM t)),
    z AS (SELECT row_index, count(*) AS n FROM s GROUP BY 1),
    j AS (SELECT a.row_index AS a, b.row_index AS b, count(*) AS c FROM s a JOIN s b ON a.run = b.run AND a.row_index < b.row_index GROUP BY 1, 2)
"""
_LAYOUT = f"""
    k AS (SELECT 'response_records' AS record_table, row_index, [{_CANON.format(c="prompt")}, {_CANON.format(c="response")}] AS key FROM response_records
        UNION ALL SELECT 'preference_records', row_index, [{_CANON.format(c="prompt")}, {_CANON.format(c="chosen")}, {_CANON.format(c="rejected")}] FROM preference_records
        UNION ALL SELECT 'raw_records', row_index, list_transform(list_sort(json_keys(payload)), lambda x: x || '=' || {_CANON.format(c="json_extract_string(payload, '$.' || x)")})
            FROM raw_records WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'),
    g AS (SELECT record_table, row_index, min(row_index) OVER (PARTITION BY record_table, key) AS rep, count(*) OVER (PARTITION BY record_table, key) AS n FROM k)
"""
_LEAKS = f"""
    d AS (SELECT doc_id, {_WORDS.format(c="text")} AS w FROM documents), b AS (SELECT item_id, {_WORDS.format(c="text")} AS w FROM benchmark),
    x AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 12], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
    y AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS run FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM b WHERE len(w) >= 13)),
    f AS (SELECT DISTINCT doc_id, item_id FROM x JOIN y ON x.run = y.run)
"""
_N_WORDS = rf"len(list_filter(regexp_split_to_array(coalesce({{c}}, ''), '[{_SPACE}]+'), lambda x: x <> ''))".replace("{85}", "{{85}}").replace("{Z}", "{{Z}}")


def oracle_sql() -> dict[str, str]:
    """Where SQL can express the result on whole tables; the rest is tested against brute force."""
    return {
        "p1_records": f"""
            WITH l AS (SELECT {_CLEAN.format(c="dataset_split")} AS split, {_N_WORDS.format(c="prompt")} + {_N_WORDS.format(c="response")} + 1 AS n FROM response_records),
            r AS (SELECT config_name, max_length AS m, n FROM l JOIN response_configs c ON l.split = {_CLEAN.format(c="c.dataset_split")})
            SELECT config_name, count(*) AS n_records, sum(n)::BIGINT AS n_words, max(least(n, m))::BIGINT AS longest FROM r GROUP BY config_name
        """,
        "p1_rules": f"""
            WITH l AS (SELECT {_CLEAN.format(c="dataset_split")} AS split, {_N_WORDS.format(c="prompt")} + {_N_WORDS.format(c="response")} + 1 AS n FROM response_records)
            SELECT config_name, count(*) FILTER (n <= max_length) AS n_whole, count(*) FILTER (n > max_length) AS n_cut, 0::BIGINT AS n_broken, 0::BIGINT AS n_overfull
            FROM l JOIN response_configs c ON l.split = {_CLEAN.format(c="c.dataset_split")} WHERE max_length > 0 GROUP BY config_name
        """,
        "p3_found": f"""
            WITH t AS (SELECT row_index, {_WORDS.format(c="(coalesce(prompt, '') || ' ' || coalesce(response, ''))")} AS w FROM response_records), {_SIMILAR}
            SELECT a AS row_index_a, b AS row_index_b FROM j JOIN z x ON x.row_index = a JOIN z y ON y.row_index = b WHERE c >= 0.5 * (x.n + y.n - c)
        """,
        "p4_found": f"""
            WITH h AS (SELECT row_index, {_CLEAN.format(c="dataset_split")} AS split, {_WORDS.format(c="prompt")} AS w FROM response_records),
            t AS (SELECT row_index, w FROM h WHERE len(w) > 0 AND split IN ('train', 'validation', 'test')), {_SIMILAR}
            SELECT a AS row_index_a, b AS row_index_b FROM j JOIN z x ON x.row_index = a JOIN z y ON y.row_index = b JOIN h p ON p.row_index = a JOIN h q ON q.row_index = b
            WHERE c >= 0.5 * (x.n + y.n - c) AND (p.split = 'train') <> (q.split = 'train')
        """,
        "p5_found": f"WITH {_LAYOUT} SELECT record_table, rep AS row_index_a, row_index AS row_index_b FROM g WHERE row_index <> rep",
        "p5_copies": f"WITH {_LAYOUT} SELECT record_table, row_index, n AS n_copies FROM g WHERE row_index = rep",
        "p6_roundtrip": """
            SELECT count(*) AS n_documents, count(*) FILTER (coalesce(length(text), 0) = 0) AS n_empty, count(*) AS n_exact
            FROM documents
        """,
        "p7_found": f"WITH {_LEAKS} SELECT doc_id, item_id FROM f",
    }
