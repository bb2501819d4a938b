"""Queries of the core operators over the test tables, and the equivalent SQL.

Every query runs over its whole tables.  Limits appear only where the limit is the operator: the
inspection limit, the training prefix of a run and the seeded samples.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import text as X
from tessera.operators import artifacts, contracts, encoding, kernels, logs, metrics, sampling, vocab
from tessera.operators.contracts import PreferenceFields, ResponseFields
from tessera.session import spread, table
from tessera.sources.json_rows import canonical_payloads

SEED, SAMPLE, TEMPERATURE, ALPHA = 42, 200, 2.0, 0.5
TOKENIZER = encoding.WordHashTokenizer()
MESSAGES = PreferenceFields(metadata=None)
NO_ID = ResponseFields(id=None, metadata=None)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# SQL pieces: white space as Python sees it, a blank test, strip, words, word-hash ids.
W = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"


def _bad(c: str) -> str:
    return f"({c} IS NULL OR NOT regexp_matches({c}, '[^{W}]'))"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{W}]+|[{W}]+$', '', 'g')"


def _rstrip(c: str) -> str:
    return f"regexp_replace({c}, '[{W}]+$', '')"


def _words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '[{W}]+'), lambda x: x <> '')"


def _ids(c: str) -> str:
    return f"list_transform({_words(c)}, lambda x: ('0x' || substr(md5(x), 1, 7))::INT + 3)"


def _norm(c: str) -> str:
    """Compatibility forms that occur in answers and predictions: the ellipsis and odd blanks."""
    return f"regexp_replace(lower({_strip(f'''replace(nfc_normalize({c}), '…', '...')''')}), '[{W}]+', ' ', 'g')"


SPLIT = f"lower({_strip('dataset_split')})"


def _split() -> Column:
    return F.lower(X.strip(F.col("dataset_split")))


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "response_records")


def _preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "preference_records")


# ---- sources -------------------------------------------------------------------------------------


@query(f"SELECT {SPLIT} AS split, count(*) AS n_rows, count(DISTINCT source) AS n_sources FROM response_records GROUP BY 1")
def response_scan(spark, sf_dir):
    return _responses(spark, sf_dir).groupBy(_split().alias("split")).agg(F.count("*").alias("n_rows"), F.countDistinct("source").alias("n_sources"))


@query(
    """
    WITH p AS (SELECT row_index, dataset_id, CASE WHEN json_valid(payload) AND json_type(payload) = 'OBJECT' THEN payload END AS j FROM raw_records)
    SELECT row_index, dataset_id, j IS NOT NULL AS readable,
        CASE dataset_id WHEN 'relay-sft' THEN j ->> '$.prompt' WHEN 'relay-instruct' THEN j ->> '$.instruction' END AS prompt,
        CASE dataset_id WHEN 'relay-sft' THEN j ->> '$.response' WHEN 'relay-instruct' THEN j ->> '$.answer' END AS response
    FROM p
    """
)
def raw_payloads(spark, sf_dir):
    fields = {"relay-sft": ("prompt", "response"), "relay-instruct": ("instruction", "answer")}
    return canonical_payloads(table(spark, sf_dir, "raw_records"), fields).select("row_index", "dataset_id", "readable", "prompt", "response")


@query(f"SELECT row_index, printf('%s-%08d', {SPLIT}, row_index) AS id FROM response_records")
def generated_ids(spark, sf_dir):
    return _responses(spark, sf_dir).select("row_index", X.generated_id(_split(), F.col("row_index")).alias("id"))


# ---- contracts -----------------------------------------------------------------------------------

_RESPONSE_CHECKED = f"""
    c AS (SELECT *, CASE WHEN {_bad("prompt")} THEN 'prompt' WHEN {_bad("response")} THEN 'response' WHEN {_bad("id")} THEN 'id'
            WHEN metadata IS NULL THEN 'metadata' END AS v FROM response_records),
    d AS (SELECT *, CASE WHEN v IS NULL AND row_number() OVER (PARTITION BY v IS NULL, id ORDER BY row_index) > 1 THEN 'duplicate_id' ELSE v END AS code FROM c)
"""
_PREFERENCE_CHECKED = f"""
    c AS (SELECT *, CASE WHEN {_bad("id")} THEN 'id' WHEN {_bad("prompt")} THEN 'prompt' WHEN {_bad("chosen")} THEN 'chosen'
            WHEN {_bad("rejected")} THEN 'rejected' WHEN chosen = rejected THEN 'identical' WHEN metadata IS NULL THEN 'metadata' END AS v FROM preference_records),
    d AS (SELECT *, CASE WHEN v IS NULL AND row_number() OVER (PARTITION BY v IS NULL, id ORDER BY row_index) > 1 THEN 'duplicate_id' ELSE v END AS code FROM c)
"""


def _bad_message(c: str) -> str:
    ok = f"list_transform({c}, lambda m: m IS NOT NULL AND NOT {_bad('m.role')} AND NOT {_bad('m.content')})"
    return f"coalesce(list_position({ok}, false), 0)"


def _bad_list(c: str) -> str:
    return f"({c} IS NULL OR len({c}) = 0)"


_MESSAGES_CHECKED = f"""
    c AS (SELECT *, CASE WHEN {_bad("id")} THEN 'id'
            WHEN {_bad_list("prompt")} THEN 'prompt' WHEN {_bad_message("prompt")} > 0 THEN 'prompt_message'
            WHEN {_bad_list("chosen")} THEN 'chosen' WHEN {_bad_message("chosen")} > 0 THEN 'chosen_message'
            WHEN {_bad_list("rejected")} THEN 'rejected' WHEN {_bad_message("rejected")} > 0 THEN 'rejected_message'
            WHEN chosen = rejected THEN 'identical' END AS v FROM preference_messages),
    d AS (SELECT *, CASE WHEN v IS NULL AND row_number() OVER (PARTITION BY v IS NULL, id ORDER BY row_index) > 1 THEN 'duplicate_id' ELSE v END AS code FROM c)
"""
_COUNTS = "SELECT code, count(*) AS n_rows FROM d WHERE code IS NOT NULL GROUP BY code"
_SUMMARY = "SELECT (SELECT count(*) FROM {t}) AS row_count, count(*) AS inspected_rows, count(DISTINCT CASE WHEN code IS NULL THEN id END) AS unique_ids, count(code) AS n_violations FROM d"
_FIRST = "SELECT min(row_index) AS row_index, arg_min(code, row_index) AS code FROM d WHERE code IS NOT NULL"


def _counts(checked: DataFrame) -> DataFrame:
    return checked.where("violation IS NOT NULL").groupBy(F.col("violation").alias("code")).agg(F.count("*").alias("n_rows"))


@query(f"WITH {_RESPONSE_CHECKED} {_COUNTS}")
def response_violations(spark, sf_dir):
    return _counts(contracts.check_rows(_responses(spark, sf_dir), ResponseFields()))


@query(f"WITH {_RESPONSE_CHECKED} SELECT row_index, code FROM d WHERE code IS NOT NULL")
def response_quarantine(spark, sf_dir):
    """Every violating row instead of an error at the first."""
    return contracts.check_rows(_responses(spark, sf_dir), ResponseFields()).where("violation IS NOT NULL").select("row_index", F.col("violation").alias("code"))


@query(f"WITH {_RESPONSE_CHECKED} {_FIRST}")
def first_violation(spark, sf_dir):
    return contracts.first_violation(contracts.check_rows(_responses(spark, sf_dir), ResponseFields()))


@query(f"WITH {_RESPONSE_CHECKED} {_SUMMARY.format(t='response_records')}")
def response_summary(spark, sf_dir):
    df = _responses(spark, sf_dir)
    return contracts.summary(df, contracts.check_rows(df, ResponseFields()), whole=True)


@query(f"WITH {_RESPONSE_CHECKED.replace('FROM response_records)', 'FROM response_records WHERE row_index < 100)')} {_SUMMARY.format(t='response_records')}")
def inspection_limit(spark, sf_dir):
    """The inspection of the first 100 rows: the row count is still the whole table's."""
    df = _responses(spark, sf_dir)
    return contracts.summary(df, contracts.check_rows(df, ResponseFields(), limit=100))


@query(f"WITH {_RESPONSE_CHECKED} SELECT row_index, id, prompt, response, cardinality(metadata)::BIGINT AS n_metadata FROM d WHERE code IS NULL")
def canonical_response(spark, sf_dir):
    rows = contracts.canonical(_responses(spark, sf_dir), ResponseFields())
    return rows.select("row_index", "id", "prompt", "response", F.size("metadata").cast("bigint").alias("n_metadata"))


@query(f"SELECT row_index, printf('train-%08d', row_index) AS id, prompt, response FROM response_records WHERE NOT {_bad('prompt')} AND NOT {_bad('response')}")
def canonical_generated(spark, sf_dir):
    """Canonical records of a source without ids and metadata."""
    return contracts.canonical(_responses(spark, sf_dir), NO_ID).select("row_index", "id", "prompt", "response")


@query(
    f"""
    WITH c AS (SELECT *, CASE WHEN {_bad("prompt")} THEN 'prompt' WHEN {_bad("response")} THEN 'response' WHEN {_bad("id")} THEN 'id' END AS v FROM response_records),
    d AS (SELECT *, CASE WHEN v IS NULL AND row_number() OVER (PARTITION BY v IS NULL, id ORDER BY row_index) > 1 THEN 'duplicate_id' ELSE v END AS code FROM c)
    {_COUNTS}
    """
)
def eval_violations(spark, sf_dir):
    """The evaluation's contract: without metadata."""
    return _counts(contracts.check_rows(_responses(spark, sf_dir), ResponseFields(metadata=None)))


@query(
    """
    SELECT row_index FROM (SELECT row_index, id, row_number() OVER (PARTITION BY id ORDER BY row_index) AS n FROM response_records WHERE id IS NOT NULL) WHERE n > 1
    """
)
def duplicate_ids(spark, sf_dir):
    return contracts.duplicate_ids(_responses(spark, sf_dir).select("row_index", "id"), F.col("id"), F.col("row_index")).where("duplicate").select("row_index")


@query(f"WITH {_PREFERENCE_CHECKED} {_COUNTS}")
def preference_violations(spark, sf_dir):
    return _counts(contracts.check_rows(_preferences(spark, sf_dir), PreferenceFields()))


@query(f"WITH {_PREFERENCE_CHECKED} {_SUMMARY.format(t='preference_records')}")
def preference_summary(spark, sf_dir):
    df = _preferences(spark, sf_dir)
    return contracts.summary(df, contracts.check_rows(df, PreferenceFields()), whole=True)


@query(f"WITH {_PREFERENCE_CHECKED} SELECT row_index, id, prompt, chosen, rejected FROM d WHERE code IS NULL")
def canonical_preference(spark, sf_dir):
    return contracts.canonical(_preferences(spark, sf_dir), PreferenceFields()).select("row_index", "id", "prompt", "chosen", "rejected")


@query("SELECT source, count(*) AS n_pairs FROM preference_records WHERE chosen IS NOT DISTINCT FROM rejected GROUP BY source")
def identical_pairs(spark, sf_dir):
    return _preferences(spark, sf_dir).where(F.col("chosen").eqNullSafe(F.col("rejected"))).groupBy("source").agg(F.count("*").alias("n_pairs"))


@query(f"WITH {_MESSAGES_CHECKED} {_COUNTS}")
def message_violations(spark, sf_dir):
    return _counts(contracts.check_rows(table(spark, sf_dir, "preference_messages"), MESSAGES))


@query(f"WITH {_MESSAGES_CHECKED} {_FIRST}")
def message_first_violation(spark, sf_dir):
    return contracts.first_violation(contracts.check_rows(table(spark, sf_dir, "preference_messages"), MESSAGES))


@query(
    "SELECT row_index, " + ", ".join(f"({_bad_message(c)} - 1)::INT AS {c}_at" for c in ("prompt", "chosen", "rejected")) + " FROM preference_messages"
)
def message_validation(spark, sf_dir):
    """Place of the first message without role or content in each field, or -1."""
    return table(spark, sf_dir, "preference_messages").select("row_index", *(contracts.bad_message(F.col(c)).alias(f"{c}_at") for c in ("prompt", "chosen", "rejected")))


@query("SELECT 'preference_records' AS record_table, 'standard' AS format, (SELECT count(*) FROM preference_records) AS n_rows UNION ALL SELECT 'preference_messages', 'conversational', (SELECT count(*) FROM preference_messages)")
def preference_format(spark, sf_dir):
    out = None
    for name, fields in (("preference_records", PreferenceFields()), ("preference_messages", MESSAGES)):
        df = table(spark, sf_dir, name)
        fmt = contracts.value_format(df.schema[fields.prompt].dataType)
        part = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("record_table"), F.lit(fmt).alias("format"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


# ---- samples and limits --------------------------------------------------------------------------


def _run_rows(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Rows of every run: of its split, numbered in source order, before its prefix limit."""
    runs = table(spark, sf_dir, "response_configs").select("config_name", F.lower(X.strip(F.col("dataset_split"))).alias("split"), "max_length", "max_train_samples", F.col("per_device_train_batch_size").alias("batch"))
    numbered = encoding.positions(rows, ["split"], "row_index")
    return numbered.join(F.broadcast(runs), "split").where(F.coalesce(F.col("position") < F.col("max_train_samples"), F.lit(True)))


_RUN_ROWS = f"""
    s AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY row_index) - 1 AS position FROM (SELECT *, {SPLIT} AS split FROM response_records {{where}})),
    r AS (SELECT s.*, c.config_name, c.max_length, c.per_device_train_batch_size AS batch FROM s JOIN response_configs c ON s.split = lower({_strip("c.dataset_split")})
          WHERE coalesce(position < c.max_train_samples, true))
"""


@query(f"WITH {_RUN_ROWS.replace('{where}', '')} SELECT config_name, count(*) AS n_rows, max(row_index) AS last_row FROM r GROUP BY config_name")
def prefix_limit(spark, sf_dir):
    """Rows of each run after its max_train_samples."""
    rows = _responses(spark, sf_dir).select("row_index", _split().alias("split"))
    return _run_rows(spark, sf_dir, rows).groupBy("config_name").agg(F.count("*").alias("n_rows"), F.max("row_index").alias("last_row"))


_SAMPLE = f"SELECT row_index, id, md5('{SEED}:' || row_index) AS sample_rank FROM {{t}} {{where}} ORDER BY sample_rank, row_index LIMIT {SAMPLE}"


@query(f"SELECT row_index, id FROM ({_SAMPLE.format(t='response_records', where=f'''WHERE {SPLIT} = 'test' ''')})")
def seeded_sample(spark, sf_dir):
    rows = _responses(spark, sf_dir).where(_split() == "test").select("row_index", "id")
    return sampling.seeded_sample(rows, SAMPLE, SEED).select("row_index", "id")


@query(
    f"""
    WITH s AS ({_SAMPLE.format(t="response_records", where="")}), p AS (SELECT row_index, row_number() OVER (ORDER BY sample_rank, row_index) - 1 AS position FROM s)
    SELECT row_index, position, printf('test-%08d', position) AS generated_id FROM p
    """
)
def seeded_sample_reindexed(spark, sf_dir):
    """Generated ids count in the sample's order, not the source's."""
    sample = sampling.seeded_sample(_responses(spark, sf_dir).select("row_index"), SAMPLE, SEED)
    return sampling.reindexed(sample, "test").select("row_index", "position", "generated_id")


@query(f"SELECT row_index, id FROM ({_SAMPLE.format(t='preference_records', where='')})")
def seeded_preference_sample(spark, sf_dir):
    return sampling.seeded_sample(_preferences(spark, sf_dir).select("row_index", "id"), SAMPLE, SEED).select("row_index", "id")


# ---- text ----------------------------------------------------------------------------------------


@query(f"SELECT row_index, {_norm('response')} AS normalized FROM response_records")
def normalize_text(spark, sf_dir):
    return _responses(spark, sf_dir).select("row_index", X.normalize_text(F.col("response")).alias("normalized"))


#: Texts with compatibility forms, and their normal forms.
_FORMS = {
    "ﬁne ﬂow": "fine flow", "①②Ⅳ": "12iv", "ＡＢＣ　ｄ": "abc d", "㎏ ㎞²": "kg km2", "½ x": "1⁄2 x", "e\u0301té": "été", "ﷺ": "صلى الله عليه وسلم", "ｶﾞ": "ガ", "™℡": "tmtel", "…wait": "...wait",
    "ſtop": "stop", "Ω K Å": "ω k å", "a\u00a0b\u2003c": "a b c", "ẛ̣": "ṩ", "㍿": "株式会社", "\u3000x\u3000": "x", "İ": "i̇", "Straße": "straße", "가": "가", "⑽ ㊀": "(10) 一", "": "",
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in _FORMS.items()) + ") t(text, normalized)")
def normalize_forms(spark, sf_dir):
    """Compatibility forms that the tables don't have."""
    df = spark.createDataFrame([(k,) for k in _FORMS], "text string")
    return df.select("text", X.normalize_text(F.col("text")).alias("normalized"))


@query(f"SELECT doc_id, length({_strip('text')})::BIGINT AS n_stripped, len({_words('text')})::BIGINT AS n_tokens FROM documents")
def whitespace_tokens(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.length(X.strip(text)).cast("bigint").alias("n_stripped"), F.when(text.isNotNull(), F.size(X.ws_tokens(text))).cast("bigint").alias("n_tokens"))


@query(f"SELECT row_index, {_rstrip('prompt')} || chr(10) AS prompt_text FROM response_records")
def plain_format(spark, sf_dir):
    return _responses(spark, sf_dir).select("row_index", encoding.plain_prompt(F.col("prompt")).alias("prompt_text"))


_SYSTEM = "Answer the question."


def _turn(role: str, c: str) -> str:
    return f"'<|' || {role} || '|>' || chr(10) || {c} || chr(10) || '<|end|>' || chr(10)"


_ANSWER = "'<|assistant|>' || chr(10)"
_SYSTEM_TURN = _turn("'system'", f"'{_SYSTEM}'")
_USER_TURN = _turn("'user'", "prompt")


@query(f"SELECT row_index, {_SYSTEM_TURN} || {_USER_TURN} || {_ANSWER} AS prompt_text FROM response_records WHERE prompt IS NOT NULL")
def chat_format(spark, sf_dir):
    rows = _responses(spark, sf_dir).where("prompt IS NOT NULL")
    return rows.select("row_index", encoding.chat_text(encoding.user_messages(F.col("prompt"), _SYSTEM), True).alias("prompt_text"))


_PLAIN = f"{_rstrip('prompt')} || chr(10)"


@query(f"WITH {_PREFERENCE_CHECKED} SELECT row_index, {_PLAIN} AS p, {_PLAIN} || chosen AS c, {_PLAIN} || rejected AS r FROM d WHERE code IS NULL")
def preference_texts(spark, sf_dir):
    rows = contracts.canonical(_preferences(spark, sf_dir), PreferenceFields())
    texts = encoding.preference_texts(F.col("prompt"), F.col("chosen"), F.col("rejected"), "standard")
    return rows.select("row_index", *(t.alias(n) for t, n in zip(texts, "pcr", strict=True)))


@query(
    f"""
    WITH {_PREFERENCE_CHECKED} SELECT row_index, {_SYSTEM_TURN} || {_USER_TURN} || {_ANSWER} AS p,
        {_SYSTEM_TURN} || {_USER_TURN} || {_turn("'assistant'", "chosen")} AS c, {_SYSTEM_TURN} || {_USER_TURN} || {_turn("'assistant'", "rejected")} AS r FROM d WHERE code IS NULL
    """
)
def preference_texts_chat(spark, sf_dir):
    rows = contracts.canonical(_preferences(spark, sf_dir), PreferenceFields())
    texts = encoding.preference_texts(F.col("prompt"), F.col("chosen"), F.col("rejected"), "standard", "chat", _SYSTEM)
    return rows.select("row_index", *(t.alias(n) for t, n in zip(texts, "pcr", strict=True)))


def _turns(c: str) -> str:
    return f"array_to_string(list_transform({c}, lambda m: {_turn('m.role', 'm.content')}), '')"


@query(f"WITH {_MESSAGES_CHECKED} SELECT row_index, {_turns('prompt')} || {_ANSWER} AS p, {_turns('prompt')} || {_turns('chosen')} AS c, {_turns('prompt')} || {_turns('rejected')} AS r FROM d WHERE code IS NULL")
def preference_texts_messages(spark, sf_dir):
    rows = contracts.canonical(table(spark, sf_dir, "preference_messages"), MESSAGES)
    texts = encoding.preference_texts(F.col("prompt"), F.col("chosen"), F.col("rejected"), "conversational")
    return rows.select("row_index", *(t.alias(n) for t, n in zip(texts, "pcr", strict=True)))


# ---- encoding ------------------------------------------------------------------------------------

_VALID = f"WHERE NOT {_bad('prompt')} AND NOT {_bad('response')}"
_PROMPT_IDS = f"list_concat([1], {_ids('prompt')})"


@query(f"SELECT {SPLIT} AS split, count(*) AS n_rows, count(*) AS n_stable FROM response_records {_VALID} GROUP BY 1")
def chat_prefix_check(spark, sf_dir):
    """Whether the ids of a whole conversation begin with those of its prompt; with words as tokens always."""
    rows = _responses(spark, sf_dir).where(X.is_text(F.col("prompt")) & X.is_text(F.col("response")))
    encoded = encoding.encode_records(rows.withColumn("split", _split()), TOKENIZER, 512, "chat", _SYSTEM, keep=("split",))
    return encoded.groupBy("split").agg(F.count("*").alias("n_rows"), F.count_if("stable").alias("n_stable"))


@query(
    f"""
    WITH t AS (SELECT row_index, {_ids("prompt")} AS ids FROM response_records WHERE prompt IS NOT NULL), b AS (SELECT unnest([0, 1, 2, 16]) AS budget)
    SELECT row_index, budget, md5(array_to_string(CASE WHEN len(ids) <= budget THEN ids WHEN budget <= 0 THEN []
        WHEN budget = 1 THEN ids[-1:] ELSE list_concat(ids[1:1], ids[-(budget - 1):]) END, ',')) AS kept FROM t, b
    """
)
def truncate_prompt(spark, sf_dir):
    rows = _responses(spark, sf_dir).where("prompt IS NOT NULL").select("row_index", TOKENIZER.ids(F.col("prompt")).alias("ids"))
    rows = rows.withColumn("budget", F.explode(F.array(*map(F.lit, (0, 1, 2, 16)))))
    kept = A.truncate_prompt(F.col("ids"), F.col("budget"))
    return rows.select("row_index", "budget", F.md5(F.array_join(F.transform(kept, lambda i: i.cast("string")), ",")).alias("kept"))


_ENCODED = f"""
    {_RUN_ROWS.replace('{where}', _VALID)},
    t AS (SELECT config_name, row_index, position, batch, max_length AS m, {_PROMPT_IDS} AS p, list_concat({_ids("response")}, [2]) AS q FROM r),
    u AS (SELECT config_name, row_index, position, batch, CASE WHEN len(q) >= m THEN [] WHEN len(p) <= m - len(q) THEN p WHEN m - len(q) = 1 THEN p[-1:]
            ELSE list_concat(p[1:1], p[-(m - len(q) - 1):]) END AS p, CASE WHEN len(q) >= m THEN list_concat(q[1:m - 1], [2]) ELSE q END AS q FROM t),
    e AS (SELECT config_name, row_index, position, batch, list_concat(p, q) AS input_ids, len(p) AS n_prompt, len(q) AS n_response, list_concat(list_transform(p, lambda x: -100), q) AS labels FROM u)
"""


def _join(c: str) -> str:
    return f"md5(array_to_string({c}, ','))"


def _digest(c: str) -> Column:
    return F.md5(F.array_join(F.transform(F.col(c), lambda i: i.cast("string")), ","))


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records are tokenised once, before they are taken into the runs of their split."""
    rows = spread(_responses(spark, sf_dir).where(X.is_text(F.col("prompt")) & X.is_text(F.col("response"))).select("row_index", "prompt", "response", _split().alias("split")))
    parts = encoding.tokenize_records(rows, TOKENIZER, keep=("row_index", "split"))
    return encoding.encode_tokenized(_run_rows(spark, sf_dir, parts), TOKENIZER.eos, F.col("max_length"), ("config_name", "row_index", "position", "batch"))


@query(f"WITH {_ENCODED} SELECT config_name, row_index, {_join('input_ids')} AS input_ids, {_join('labels')} AS labels, len(input_ids)::BIGINT AS n_tokens FROM e")
def encode_response(spark, sf_dir):
    """Every run's training rows: ids and labels."""
    return _encoded(spark, sf_dir).select("config_name", "row_index", _digest("input_ids").alias("input_ids"), _digest("labels").alias("labels"), F.size("attention_mask").cast("bigint").alias("n_tokens"))


@query(f"WITH {_ENCODED} SELECT config_name, count(*) AS n_rows, sum(n_prompt)::BIGINT AS n_masked, sum(n_response)::BIGINT AS n_supervised FROM e GROUP BY config_name")
def label_mask_counts(spark, sf_dir):
    masked = F.size(F.filter("labels", lambda v: v == A.IGNORED))
    rows = _encoded(spark, sf_dir).select("config_name", masked.alias("m"), F.size("labels").alias("n"))
    return rows.groupBy("config_name").agg(F.count("*").alias("n_rows"), F.sum("m").alias("n_masked"), F.sum(F.col("n") - F.col("m")).alias("n_supervised"))


def _padded_sql(left: bool) -> str:
    def pad(c: str, v: int) -> str:
        fill = f"list_transform(range(width - len({c})), lambda x: {v})"
        return _join(f"list_concat({fill}, {c})" if left else f"list_concat({c}, {fill})")

    return f"""
        WITH {_ENCODED}, b AS (SELECT *, position // batch AS batch_id FROM e),
        w AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY config_name, batch_id) AS width FROM b)
        SELECT config_name, row_index, batch_id, width::INT AS width, {pad("input_ids", 0)} AS input_ids, {pad("labels", -100)} AS labels FROM w
    """


@query(_padded_sql(False))
def batch_padding_right(spark, sf_dir):
    return _padded_rows(spark, sf_dir, "right")


@query(_padded_sql(True))
def batch_padding_left(spark, sf_dir):
    return _padded_rows(spark, sf_dir, "left")


def _padded_rows(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    rows = encoding.pad_batches(_encoded(spark, sf_dir), "position", F.col("batch"), TOKENIZER.pad, side, ("config_name",), ("row_index",))
    return rows.select("config_name", "row_index", "batch_id", "width", _digest("input_ids").alias("input_ids"), _digest("labels").alias("labels"))


@query(f"WITH {_PREFERENCE_CHECKED} SELECT prompt, chosen, rejected FROM d WHERE code IS NULL")
def dpo_rows(spark, sf_dir):
    """The three columns of preference training; ids and metadata are projected away."""
    return contracts.canonical(_preferences(spark, sf_dir), PreferenceFields()).select("prompt", "chosen", "rejected")


# ---- kernels -------------------------------------------------------------------------------------


def _logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored logits: student is a vector, teacher the next one; eight positions a sequence; every
    fifth label isn't supervised."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("student"), F.col("label").cast("int").alias("label"))
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("student").alias("teacher"))
    label = F.when(F.col("vec_id") % 5 == 0, F.lit(A.IGNORED)).otherwise(F.col("label"))
    return e.join(after, "vec_id").select("vec_id", F.floor(F.col("vec_id") / 8).cast("bigint").alias("seq"), (F.col("vec_id") % 8).alias("pos"), label.alias("label"), "student", "teacher")


_LOGITS = """
    e AS (SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS student, label FROM embeddings),
    g AS (SELECT a.vec_id, a.vec_id // 8 AS seq, a.vec_id % 8 AS pos, CASE WHEN a.vec_id % 5 = 0 THEN -100 ELSE a.label END AS label, a.student, b.student AS teacher
          FROM e a JOIN e b ON b.vec_id = a.vec_id + 1)
"""


def _lse(x: str) -> str:
    return f"(list_max({x}) + ln(list_sum(list_transform({x}, lambda v: exp(v - list_max({x}))))))"


@query(
    f"""
    WITH {_LOGITS}, h AS (SELECT vec_id, list_transform(student, lambda v: v / {TEMPERATURE}) AS x FROM g)
    SELECT vec_id, round(list_max(x) - {_lse("x")}, 6) AS top, round(list_min(x) - {_lse("x")}, 6) AS low, round(x[1] - {_lse("x")}, 6) AS first FROM h
    """
)
def log_softmax(spark, sf_dir):
    rows = _logits(spark, sf_dir).select("vec_id", A.log_softmax(F.col("student"), TEMPERATURE).alias("x"))
    return rows.select("vec_id", F.round(F.array_max("x"), 6).alias("top"), F.round(F.array_min("x"), 6).alias("low"), F.round(F.element_at("x", 1), 6).alias("first"))


_LOSSES = f"""
    {_LOGITS}, t AS (SELECT *, lead(label) OVER (PARTITION BY seq ORDER BY pos) AS target FROM g),
    u AS (SELECT *, list_transform(student, lambda v: v / {TEMPERATURE}) AS s2, list_transform(teacher, lambda v: v / {TEMPERATURE}) AS t2 FROM t WHERE target <> -100),
    v AS (SELECT *, {_lse("s2")} AS zs, {_lse("t2")} AS zt, {_lse("student")} AS z FROM u),
    l AS (SELECT vec_id, seq, pos, list_sum(list_transform(list_zip(t2, s2), lambda x: exp(x[1] - zt) * ((x[1] - zt) - (x[2] - zs)))) AS kl, z - student[target + 1] AS nll FROM v)
"""


def _losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kernels.token_losses(kernels.supervised(_logits(spark, sf_dir)), TEMPERATURE)


@query(f"WITH {_LOSSES} SELECT vec_id, round(kl, 6) AS kl FROM l")
def token_kl(spark, sf_dir):
    return _losses(spark, sf_dir).select("vec_id", F.round("kl", 6).alias("kl"))


@query(f"WITH {_LOSSES} SELECT vec_id, round(nll, 6) AS nll FROM l")
def hard_cross_entropy(spark, sf_dir):
    return _losses(spark, sf_dir).select("vec_id", F.round("nll", 6).alias("nll"))


@query(
    f"""
    WITH {_LOSSES} SELECT seq // 2 AS batch_id, count(*) AS n_tokens, round(avg(nll), 6) AS hard_loss, round(avg(kl) * {TEMPERATURE * TEMPERATURE}, 6) AS soft_loss,
        round({ALPHA} * avg(nll) + {1 - ALPHA} * avg(kl) * {TEMPERATURE * TEMPERATURE}, 6) AS loss FROM l GROUP BY 1
    """
)
def distillation_loss(spark, sf_dir):
    losses = _losses(spark, sf_dir).withColumn("batch_id", F.floor(F.col("seq") / 2).cast("bigint"))
    out = kernels.distillation_loss(losses, "batch_id", TEMPERATURE, ALPHA)
    return out.select("batch_id", "n_tokens", *(F.round(c, 6).alias(c) for c in ("hard_loss", "soft_loss", "loss")))


def _scores(spark: SparkSession, sf_dir: str, max_length: int = 6) -> DataFrame:
    rows = _logits(spark, sf_dir).select("seq", F.struct("pos", F.greatest("label", F.lit(0)).alias("id"), "student").alias("x"))
    seqs = rows.groupBy("seq").agg(F.array_sort(F.collect_list("x")).alias("xs"))  # at most eight positions
    ids = F.transform("xs", lambda x: x["id"])
    out = seqs.select("seq", kernels.conditional_log_prob(ids, F.slice(ids, 1, 2), F.transform("xs", lambda x: x["student"]), max_length).alias("s"))
    return out.select("seq", "s.score", "s.violation")


_SCORES = f"""
    {_LOGITS}, q AS (SELECT seq, list(greatest(label, 0) ORDER BY pos)[1:6] AS ids, list(student ORDER BY pos) AS x FROM g GROUP BY seq),
    k AS (SELECT seq, ids, x, len(ids) AS n FROM q),
    z AS (SELECT seq, CASE WHEN n <= 2 THEN NULL ELSE list_sum(list_transform(range(2, n), lambda i: x[i][ids[i + 1] + 1] - {_lse("x[i]")})) END AS score,
            CASE WHEN n <= 2 THEN 'no_completion' END AS violation FROM k)
"""


@query(f"WITH {_SCORES} SELECT seq, round(score, 6) AS score, violation FROM z")
def conditional_logprob(spark, sf_dir):
    return _scores(spark, sf_dir).select("seq", F.round("score", 6).alias("score"), "violation")


@query(
    f"""
    WITH {_SCORES} SELECT count(*) AS n_pairs, round(avg(CASE WHEN round(a.score, 6) > round(b.score, 6) THEN 1.0 WHEN round(a.score, 6) = round(b.score, 6) THEN 0.5 ELSE 0.0 END), 6) AS win_rate
    FROM z a JOIN z b ON b.seq = a.seq + 1 WHERE a.score IS NOT NULL AND b.score IS NOT NULL
    """
)
def preference_win_rate(spark, sf_dir):
    s = _scores(spark, sf_dir).where("score IS NOT NULL").select("seq", F.round("score", 6).alias("chosen"))
    other = s.select((F.col("seq") - 1).alias("seq"), F.col("chosen").alias("rejected"))
    return s.join(other, "seq").agg(F.count("*").alias("n_pairs"), F.round(kernels.win_rate(F.col("chosen"), F.col("rejected")), 6).alias("win_rate"))


@query(
    """
    WITH t AS (SELECT run_name, stage, step, logs['loss'] AS loss, logs['loss_hard'] AS loss_hard, logs['loss_soft'] AS loss_soft FROM train_log)
    SELECT run_name, stage, (step - 1) // 100 AS "window", count(*) AS n_events,
        round(avg(loss) FILTER (NOT isnan(loss)), 6) AS loss, round(avg(loss_hard) FILTER (NOT isnan(loss_hard)), 6) AS loss_hard, round(avg(loss_soft) FILTER (NOT isnan(loss_soft)), 6) AS loss_soft
    FROM t GROUP BY ALL
    """
)
def loss_windows(spark, sf_dir):
    values = ["loss", "loss_hard", "loss_soft"]
    rows = table(spark, sf_dir, "train_log").select("run_name", "stage", "step", *(F.try_element_at("logs", F.lit(v)).alias(v) for v in values))
    out = kernels.loss_windows(rows, ["run_name", "stage"], "step", 100, values)
    return out.select("run_name", "stage", "window", "n_events", *(F.round(v, 6).alias(v) for v in values))


_FORMAT = """CASE WHEN isnan({v}) THEN 'nan' WHEN {v} <> 0 AND (abs({v}) < 0.0001 OR abs({v}) >= 10000) THEN printf('%.3e', {v}) ELSE regexp_replace(printf('%.4f', {v}), '\\.?0+$', '') END"""


def _part(key: str, label: str) -> str:
    v = f"logs['{key}']"
    return f"CASE WHEN list_contains(map_keys(logs), '{key}') THEN ' | {label} ' || {_FORMAT.format(v=v)} ELSE '' END"


@query(
    f"""
    SELECT log_id, '[' || stage || '] step ' || step || CASE WHEN max_steps > 0 THEN '/' || max_steps ELSE '' END || {_part("loss", "loss")} || {_part("learning_rate", "lr")}
        || CASE WHEN list_contains(map_keys(logs), 'loss_hard') OR list_contains(map_keys(logs), 'loss_soft') THEN ' | components' || {_part("loss_hard", "hard")} || {_part("loss_soft", "soft_kl")} ELSE '' END AS line
    FROM train_log WHERE len(list_intersect(map_keys(logs), ['loss', 'learning_rate', 'loss_hard', 'loss_soft'])) > 0
    """
)
def log_lines(spark, sf_dir):
    names = F.transform_keys("logs", lambda k, v: F.when(k == "loss_hard", "loss/hard").when(k == "loss_soft", "loss/soft_kl").otherwise(k))
    line = logs.log_line(F.col("stage"), F.col("step"), F.col("max_steps"), names)
    return table(spark, sf_dir, "train_log").select("log_id", line.alias("line")).where("line IS NOT NULL")


# ---- evaluation ----------------------------------------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = contracts.canonical(_responses(spark, sf_dir), ResponseFields(metadata=None)).select("id", F.col("response").alias("reference"))
    return metrics.samples_with_predictions(samples, table(spark, sf_dir, "predictions"))


_PAIRS = f"""
    c AS (SELECT *, CASE WHEN {_bad("prompt")} OR {_bad("response")} OR {_bad("id")} THEN 1 ELSE 0 END AS v FROM response_records),
    s AS (SELECT id, arg_min(response, row_index) AS reference, arg_min(prompt, row_index) AS prompt FROM c WHERE v = 0 GROUP BY id),
    o AS (SELECT model, id, min(prediction) AS prediction FROM predictions GROUP BY model, id),
    p AS (SELECT model, o.id, prompt, reference, coalesce(prediction, '') AS prediction FROM o JOIN s ON o.id = s.id),
    n AS (SELECT *, {_norm("prediction")} AS np, {_norm("reference")} AS nr FROM p),
    t AS (SELECT *, {_words("np")} AS pt, {_words("nr")} AS rt FROM n),
    f AS (SELECT *, list_sum(list_transform(list_distinct(pt), lambda x: least(len(list_filter(pt, lambda y: y = x)), len(list_filter(rt, lambda y: y = x))))) AS o FROM t),
    x AS (SELECT *, CASE WHEN len(pt) = 0 AND len(rt) = 0 THEN 1.0 WHEN len(pt) = 0 OR len(rt) = 0 OR o = 0 THEN 0.0
            ELSE 2 * (o / len(pt)) * (o / len(rt)) / (o / len(pt) + o / len(rt)) END AS f1 FROM f),
    m AS (SELECT model, count(*) AS examples, avg(CASE WHEN {_strip("prediction")} = {_strip("reference")} THEN 1.0 ELSE 0.0 END) AS exact_match,
            avg(CASE WHEN np = nr THEN 1.0 ELSE 0.0 END) AS normalized_exact_match, avg(f1) AS token_f1,
            avg(CASE WHEN {_bad("prediction")} THEN 0.0 ELSE 1.0 END) AS non_empty_rate, avg(length(prediction)) AS average_output_characters FROM x GROUP BY model)
"""


@query(f"WITH {_PAIRS} SELECT model, id, round(f1, 6) AS token_f1 FROM x")
def token_f1(spark, sf_dir):
    return metrics.scored(_pairs(spark, sf_dir)).select("model", "id", F.round("token_f1", 6).alias("token_f1"))


@query(f"WITH {_PAIRS} SELECT model, id, round(f1, 6) AS token_f1 FROM x")
def token_f1_relational(spark, sf_dir):
    return metrics.token_f1_by_id(_pairs(spark, sf_dir), ["model", "id"]).select("model", "id", F.round("token_f1", 6).alias("token_f1"))


@query(f"WITH {_PAIRS} SELECT model, examples, " + ", ".join(f"round({c}, 6) AS {c}" for c in metrics.METRICS) + " FROM m")
def metrics_by_model(spark, sf_dir):
    out = metrics.metrics_by_model(_pairs(spark, sf_dir))
    return out.select("model", "examples", *(F.round(c, 6).alias(c) for c in metrics.METRICS))


@query(f"WITH {_PAIRS} SELECT b.model AS baseline, m.model, " + ", ".join(f"round(m.{c} - b.{c}, 6) AS {c}_delta" for c in metrics.METRICS[:4]) + " FROM m, (SELECT * FROM m WHERE model = 'base') b WHERE m.model <> 'base'")
def model_comparison(spark, sf_dir):
    """Every model's metrics minus the baseline's."""
    out = metrics.comparisons(metrics.metrics_by_model(_pairs(spark, sf_dir)), "base")
    return out.select("baseline", "model", *(F.round(f"{c}_delta", 6).alias(f"{c}_delta") for c in metrics.METRICS[:4]))


@query(f"WITH {_PAIRS} SELECT model, id, to_json({{'id': id, 'prompt': prompt, 'reference': reference, 'prediction': prediction}})::VARCHAR AS line FROM p")
def prediction_jsonl(spark, sf_dir):
    from tessera.sources.sinks import prediction_lines

    samples = contracts.canonical(_responses(spark, sf_dir), ResponseFields(metadata=None)).select("id", "prompt", F.col("response").alias("reference"))
    one = metrics.unique_predictions(table(spark, sf_dir, "predictions")).join(samples, "id").withColumn("prediction", F.coalesce("prediction", F.lit("")))
    return prediction_lines(one)


# ---- vocabularies and artifacts ------------------------------------------------------------------


def _vocab(spark: SparkSession, sf_dir: str, column: str, shift: int) -> DataFrame:
    words = _preferences(spark, sf_dir).select(F.explode(X.ws_tokens(F.col(column))).alias("token")).distinct()
    number = F.conv(F.substring(F.md5("token"), 1, 7), 16, 10).cast("bigint")
    return words.select("token", (number + F.when(F.length("token") % 7 == 0, shift).otherwise(0)).alias("id"))


def _vocab_sql(column: str, shift: int) -> str:
    return f"SELECT DISTINCT token, ('0x' || substr(md5(token), 1, 7))::BIGINT + CASE WHEN length(token) % 7 = 0 THEN {shift} ELSE 0 END AS id FROM (SELECT unnest({_words(column)}) AS token FROM preference_records)"


@query(
    f"""
    WITH t AS ({_vocab_sql("prompt", 0)}), s AS ({_vocab_sql("chosen", 1)})
    SELECT coalesce(t.token, s.token) AS token, t.id AS teacher_id, s.id AS student_id FROM t FULL JOIN s ON t.token = s.token WHERE t.id IS DISTINCT FROM s.id
    """
)
def vocab_diff(spark, sf_dir):
    return vocab.vocab_diff(_vocab(spark, sf_dir, "prompt", 0), _vocab(spark, sf_dir, "chosen", 1))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    path = F.concat_ws("/", "doc_type", F.col("doc_id").cast("string"))
    return docs.select(F.col("doc_id").alias("ordinal"), path.alias("path"), F.octet_length("text").cast("bigint").alias("size_bytes"), F.sha2("text", 256).alias("sha256"))


def _actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _manifest(spark, sf_dir).where("ordinal % 97 <> 0")
    return m.select("path", F.when(F.col("ordinal") % 89 == 0, F.col("size_bytes") + 1).otherwise(F.col("size_bytes")).alias("size_bytes"), F.when(F.col("ordinal") % 83 == 0, F.lit("x")).otherwise(F.col("sha256")).alias("sha256"))


_MANIFEST = """
    m AS (SELECT doc_id AS ordinal, concat_ws('/', doc_type, doc_id) AS path, octet_length(encode(text))::BIGINT AS size_bytes, sha256(text) AS sha256 FROM documents WHERE text IS NOT NULL),
    v AS (SELECT ordinal, path, CASE WHEN ordinal % 97 = 0 THEN 'missing' WHEN ordinal % 89 = 0 THEN 'size' WHEN ordinal % 83 = 0 THEN 'checksum' END AS problem FROM m)
"""


@query(f"WITH {_MANIFEST} SELECT path, size_bytes, sha256 FROM m")
def manifest_rows(spark, sf_dir):
    return _manifest(spark, sf_dir).select("path", "size_bytes", "sha256")


@query(f"WITH {_MANIFEST} SELECT count(*) AS file_count, sum(size_bytes)::BIGINT AS total_bytes FROM m")
def manifest_totals(spark, sf_dir):
    return artifacts.totals(_manifest(spark, sf_dir))


@query(f"WITH {_MANIFEST} SELECT ordinal, path, problem FROM v WHERE problem IS NOT NULL")
def manifest_verify(spark, sf_dir):
    return artifacts.verify(_manifest(spark, sf_dir), _actual(spark, sf_dir)).where("problem IS NOT NULL")


@query(f"WITH {_MANIFEST} SELECT min(ordinal) AS ordinal, arg_min(path, ordinal) AS path, arg_min(problem, ordinal) AS problem FROM v WHERE problem IS NOT NULL")
def manifest_first_problem(spark, sf_dir):
    return artifacts.first_problem(artifacts.verify(_manifest(spark, sf_dir), _actual(spark, sf_dir)))


def _stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.concat_ws("/", F.lit("run"), F.col("doc_id").cast("string")).alias("key"), "lang")
    return artifacts.stale_keys(docs, docs.where("lang = 'de'"))


_STALE = "SELECT 'run/' || doc_id AS key FROM documents EXCEPT SELECT 'run/' || doc_id FROM documents WHERE lang = 'de'"


@query(_STALE)
def stale_keys(spark, sf_dir):
    return _stale(spark, sf_dir)


@query(f"SELECT (row_number() OVER (ORDER BY key) - 1) // {artifacts.DELETE_BATCH} AS batch, key FROM ({_STALE})")
def delete_batches(spark, sf_dir):
    return artifacts.delete_batches(_stale(spark, sf_dir))


# ---- further parts of the operators above --------------------------------------------------------

_CHAT_PROMPT = f"{_SYSTEM_TURN} || {_USER_TURN} || {_ANSWER}"
_CHAT_FULL = f"{_SYSTEM_TURN} || {_USER_TURN} || {_turn(chr(39) + 'assistant' + chr(39), 'response')}"


@query(
    f"""
    WITH t AS (SELECT row_index, {_ids(_CHAT_PROMPT)} AS p, {_ids(_CHAT_FULL)} AS f FROM response_records {_VALID}),
    u AS (SELECT row_index, p, f[1:len(p)] = p AS stable, list_concat(f[len(p) + 1:], CASE WHEN f[-1] = 2 THEN [] ELSE [2] END) AS q FROM t),
    v AS (SELECT row_index, stable, CASE WHEN len(q) >= 64 THEN [] WHEN len(p) <= 64 - len(q) THEN p WHEN 64 - len(q) = 1 THEN p[-1:]
            ELSE list_concat(p[1:1], p[-(64 - len(q) - 1):]) END AS p, CASE WHEN len(q) >= 64 THEN list_concat(q[1:63], [2]) ELSE q END AS q FROM u)
    SELECT row_index, stable, {_join('list_concat(p, q)')} AS input_ids, {_join('list_concat(list_transform(p, lambda x: -100), q)')} AS labels FROM v
    """
)
def chat_encode(spark, sf_dir):
    """Chat mode: the response is what follows the prompt's ids in the conversation's."""
    rows = spread(_responses(spark, sf_dir).where(X.is_text(F.col("prompt")) & X.is_text(F.col("response"))).select("row_index", "prompt", "response"))
    encoded = encoding.encode_records(rows, TOKENIZER, 64, "chat", _SYSTEM, keep=("row_index",))
    return encoded.select("row_index", "stable", _digest("input_ids").alias("input_ids"), _digest("labels").alias("labels"))


@query(
    f"""
    WITH {_PREFERENCE_CHECKED.replace("FROM preference_records)", f"FROM (SELECT * FROM preference_records ORDER BY md5('{SEED}:' || row_index), row_index LIMIT {SAMPLE}))")}
    SELECT row_index, coalesce(code, 'sound') AS code, CASE WHEN code IS NULL THEN id END AS id, CASE WHEN code IS NULL THEN md5(prompt || chosen || rejected) END AS texts FROM d
    """
)
def seeded_preference_records(spark, sf_dir):
    """The seeded sample converted: canonical values of sound records, the violation of others."""
    fields = PreferenceFields()
    checked = contracts.check_rows(sampling.seeded_sample(_preferences(spark, sf_dir), SAMPLE, SEED), fields)
    texts = contracts.renamed(checked, fields).select("row_index", "id", F.md5(F.concat("prompt", "chosen", "rejected")).alias("texts"))
    return checked.select("row_index", F.coalesce("violation", F.lit("sound")).alias("code")).join(texts, "row_index", "left").select("row_index", "code", "id", "texts")


_MIXED = """
    j AS (SELECT row_index, prompt AS p, chosen AS c, rejected AS r, row_index % 11 = 0 AS mix, row_index % 13 = 0 AS gone FROM preference_records),
    m AS (SELECT row_index + 100000000 AS row_index, len(prompt) AS p, len(chosen) AS c, len(rejected) AS r FROM preference_messages)
"""


@query(
    f"""
    WITH {_MIXED}, f AS (
        SELECT row_index, p IS NULL AS np, c IS NULL OR gone AS nc, r IS NULL AS nr, mix FROM j),
    a AS (SELECT row_index, CASE WHEN np THEN 'prompt' WHEN mix AND NOT nc AND NOT nr THEN 'mixed_formats' WHEN nc THEN 'chosen' WHEN nr AND NOT mix THEN 'rejected' WHEN mix THEN 'mixed_formats' END AS violation FROM f),
    b AS (SELECT row_index, CASE WHEN coalesce(p, 0) = 0 THEN 'prompt' WHEN coalesce(c, 0) = 0 THEN 'chosen' WHEN coalesce(r, 0) = 0 THEN 'rejected' ELSE 'dataset_format' END AS violation FROM m)
    SELECT coalesce(violation, 'sound') AS violation, count(*) AS n_rows FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1
    """
)
def mixed_formats(spark, sf_dir):
    """JSON rows of text and of messages in one source; every eleventh text row has a message as its
    rejected answer, every thirteenth has no chosen one."""
    text = _preferences(spark, sf_dir)
    one = F.array(F.struct(F.lit("user").alias("role"), F.lit("x").alias("content")))
    row = lambda c, r: F.to_json(F.struct(F.col("prompt").alias("prompt"), c.alias("chosen"), r.alias("rejected")))
    chosen = F.when(F.col("row_index") % 13 != 0, F.col("chosen"))
    payload = F.when(F.col("row_index") % 11 == 0, row(chosen, one)).otherwise(row(chosen, F.col("rejected")))
    messages = table(spark, sf_dir, "preference_messages").select((F.col("row_index") + 100_000_000).alias("row_index"), row(F.col("chosen"), F.col("rejected")).alias("payload"))
    rows = text.select("row_index", payload.alias("payload")).unionByName(messages)
    return contracts.json_formats(rows, "payload").groupBy(F.coalesce("violation", F.lit("sound")).alias("violation")).agg(F.count("*").alias("n_rows"))


@query(
    """
    WITH w AS (SELECT config_name, unnest(['prompt', 'response', id_field, metadata_field]) AS "column" FROM response_configs)
    SELECT DISTINCT config_name, "column" FROM w WHERE "column" IS NOT NULL AND "column" NOT IN (SELECT column_name FROM information_schema.columns WHERE table_name = 'raw_records')
    """
)
def missing_columns(spark, sf_dir):
    """Configured columns of each run that the export's table doesn't have."""
    wanted = table(spark, sf_dir, "response_configs").select("config_name", F.explode(F.array(F.lit("prompt"), F.lit("response"), "id_field", "metadata_field")).alias("column"))
    return contracts.missing_columns(table(spark, sf_dir, "raw_records"), wanted, "config_name", "column")


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tokenizer's JSON payload for each document type: its vocabulary are the languages, its added
    tokens the run names in their order."""
    d = table(spark, sf_dir, "documents").where("doc_type IS NOT NULL")
    tokens = d.where("lang IS NOT NULL").groupBy("doc_type", "lang").agg(F.min("doc_id").alias("id")).groupBy("doc_type").agg(F.map_from_entries(F.collect_list(F.struct("lang", "id"))).alias("vocab"))
    added = d.where("run_name IS NOT NULL").groupBy("doc_type", "run_name").agg(F.min("doc_id").alias("id")).groupBy("doc_type").agg(F.sort_array(F.collect_list(F.struct("id", F.col("run_name").alias("content")))).alias("added"))
    rows = tokens.join(added, "doc_type", "left").withColumn("added", F.coalesce("added", F.array().cast("array<struct<id:bigint,content:string>>")))
    nested = F.struct(F.struct("vocab").alias("model"), F.col("added").alias("added_tokens"), F.lit("</s>").alias("eos_token"), F.lit(7).alias("pad_token"))
    flat = F.struct(F.col("vocab"), F.col("added").alias("added_tokens"), F.lit(5).alias("eos_token"), F.col("doc_type").alias("bos_token"))
    return rows.select("doc_type", F.when(F.length("doc_type") % 2 == 0, F.to_json(nested)).otherwise(F.to_json(flat)).alias("payload"))


@query("SELECT doc_type, lang AS token, min(doc_id) AS id FROM documents WHERE doc_type IS NOT NULL AND lang IS NOT NULL GROUP BY ALL")
def payload_vocab(spark, sf_dir):
    """Tokens of payloads that keep them under the model, or at the top."""
    return vocab.payload_vocab(_payloads(spark, sf_dir), "payload", ("doc_type",))


_SPECIALS = """
    r AS (SELECT doc_type, run_name, min(doc_id) AS id FROM documents WHERE doc_type IS NOT NULL AND run_name IS NOT NULL GROUP BY ALL),
    a AS (SELECT doc_type, string_agg('{"content":"' || run_name || '","id":' || id || '}', ',' ORDER BY id, run_name) AS added FROM r GROUP BY doc_type),
    t AS (SELECT DISTINCT doc_type FROM documents WHERE doc_type IS NOT NULL AND lang IS NOT NULL),
    p AS (SELECT doc_type, '{"added_tokens":[' || coalesce(added, '') || '],' || CASE WHEN length(doc_type) % 2 = 0 THEN '"eos_token":"</s>"' ELSE '"bos_token":"' || doc_type || '"' END || '}' AS specials
          FROM t LEFT JOIN a USING (doc_type))
"""


@query(f"WITH {_SPECIALS} SELECT doc_type, specials FROM p")
def payload_specials(spark, sf_dir):
    """Special tokens of payloads; those of another type than theirs don't count."""
    return _payloads(spark, sf_dir).select("doc_type", vocab.payload_specials("payload").alias("specials"))


@query(
    f"""
    WITH {_SPECIALS}, v AS (SELECT doc_type, lang, min(doc_id) AS id FROM documents WHERE doc_type IS NOT NULL AND lang IS NOT NULL GROUP BY ALL),
    k AS (SELECT x.doc_type AS a, y.doc_type AS b FROM t x, t y),
    d AS (SELECT a, b, count(*) AS n FROM k JOIN (SELECT l.doc_type AS a, l.lang, l.id, r.b, r.id AS other FROM v l JOIN (SELECT doc_type AS b, lang, id FROM v) r ON l.lang = r.lang WHERE l.id = r.id) USING (a, b) GROUP BY ALL),
    c AS (SELECT doc_type, count(*) AS n FROM v GROUP BY 1)
    SELECT k.a || ' - ' || k.b AS pair, CASE WHEN coalesce(d.n, 0) <> x.n OR coalesce(d.n, 0) <> y.n THEN 'vocab_mismatch' WHEN p.specials <> q.specials THEN 'special_tokens_mismatch' ELSE 'compatible' END AS reason
    FROM k LEFT JOIN d USING (a, b) JOIN c x ON x.doc_type = k.a JOIN c y ON y.doc_type = k.b JOIN p ON p.doc_type = k.a JOIN p q ON q.doc_type = k.b
    UNION ALL SELECT doc_type || ' - changed', 'special_tokens_mismatch' FROM p
    """
)
def tokenizer_gate(spark, sf_dir):
    """Every payload with every payload, and with itself under another end token.  The document types
    are few, a payload is one row."""
    p = _payloads(spark, sf_dir)
    other = p.select(F.col("doc_type").alias("o"), F.col("payload").alias("student"))
    changed = F.regexp_replace("payload", r'"(eos_token":"</s>|bos_token":"[^"]*)"', r'"unk_token":"?"')
    pairs = p.crossJoin(F.broadcast(other)).select(F.concat_ws(" - ", "doc_type", "o").alias("pair"), "payload", "student")
    pairs = pairs.unionByName(p.select(F.concat(F.col("doc_type"), F.lit(" - changed")).alias("pair"), "payload", changed.alias("student")))
    return vocab.gate_of(pairs, "payload", "student", "pair")



@query(
    """
    WITH w AS (SELECT DISTINCT row_index, micro FROM (SELECT model, id, row_number() OVER (ORDER BY model, id) - 1 AS row_index FROM (SELECT DISTINCT model, id FROM predictions WHERE id IS NOT NULL)) x, (SELECT 8 AS micro)),
    b AS (SELECT row_index // micro AS batch_id, row_index FROM w)
    SELECT batch_id, count(*) AS n_rows, min(row_index) AS first_row, max(row_index) AS last_row FROM b GROUP BY 1
    """
)
def micro_batches(spark, sf_dir):
    """Prompts as a generator takes them: eight consecutive ones at a time."""
    rows = table(spark, sf_dir, "predictions").where("id IS NOT NULL").select("model", "id").distinct().withColumn("k", F.concat_ws("\x01", "model", "id"))
    numbered = artifacts.delete_batches(rows, "k", 1).withColumnRenamed("batch", "row_index")
    out = encoding.micro_batches(numbered, "row_index", 8)
    return out.groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.min("row_index").alias("first_row"), F.max("row_index").alias("last_row"))


@query(
    f"""
    WITH {_LOGITS}, t AS (SELECT *, lead(label) OVER (PARTITION BY seq ORDER BY pos) AS target FROM g)
    SELECT seq, pos // 2 AS part FROM t GROUP BY ALL HAVING count(*) FILTER (target <> -100) = 0
    """
)
def empty_batches(spark, sf_dir):
    """Pairs of positions without a supervised one."""
    df = _logits(spark, sf_dir).withColumn("b", F.concat_ws(":", "seq", F.floor(F.col("pos") / 2).cast("string")))
    bad = kernels.empty_batches(df, kernels.supervised(df), "b")
    return bad.select(F.split_part("b", F.lit(":"), F.lit(1)).cast("bigint").alias("seq"), F.split_part("b", F.lit(":"), F.lit(2)).cast("bigint").alias("part"))


@query(
    f"""
    WITH {_LOGITS}, q AS (SELECT seq, list(greatest(label, 0) ORDER BY pos) AS ids FROM g GROUP BY seq)
    SELECT seq, CASE WHEN ids[1:2] <> [0, 1] AND len(ids) >= 2 OR len(ids) < 2 THEN 'prompt_not_prefix' WHEN len(ids) <= 2 THEN 'no_completion' END AS violation FROM q
    """
)
def unscored_prompts(spark, sf_dir):
    """Why conversations can't be scored after a prompt that few of them begin with."""
    rows = _logits(spark, sf_dir).select("seq", F.struct("pos", F.greatest("label", F.lit(0)).alias("id"), "student").alias("x"))
    seqs = rows.groupBy("seq").agg(F.array_sort(F.collect_list("x")).alias("xs"))  # at most eight positions
    ids = F.transform("xs", lambda x: x["id"])
    score = kernels.conditional_log_prob(ids, F.array(F.lit(0), F.lit(1)), F.transform("xs", lambda x: x["student"]), 6)
    return seqs.select("seq", score["violation"].alias("violation"))


@query(
    f"""
    WITH {_SCORES}, p AS (SELECT a.seq, 0.1 * ((a.score - b.score) - (b.score - c.score)) AS x FROM z a JOIN z b ON b.seq = a.seq + 1 JOIN z c ON c.seq = a.seq + 2)
    SELECT seq, round(-ln(1 / (1 + exp(-x))), 5) AS loss FROM p WHERE x IS NOT NULL
    """
)
def preference_loss(spark, sf_dir):
    """Sigmoid preference loss over stored scores, four neighbours standing for the four of a pair."""
    s = _scores(spark, sf_dir).select("seq", "score")
    near = lambda k, name: s.select((F.col("seq") - k).alias("seq"), F.col("score").alias(name))
    rows = s.join(near(1, "b"), "seq").join(near(2, "c"), "seq")
    loss = kernels.preference_loss(F.col("score"), F.col("b"), F.col("b"), F.col("c"), 0.1)
    return rows.select("seq", F.round(loss, 5).alias("loss")).where("loss IS NOT NULL")


@query(
    f"""
    WITH t AS (SELECT log_id, stage, step, max_steps, logs['loss'] AS x, (log_id % 3) AS kind FROM train_log WHERE list_contains(map_keys(logs), 'loss')),
    u AS (SELECT *, x * 3 AS g, x / 7 AS m, 1 / (1 + x) AS a FROM t)
    SELECT log_id, '[' || stage || '] step ' || step || CASE WHEN max_steps > 0 THEN '/' || max_steps ELSE '' END
        || CASE WHEN kind <> 0 THEN ' | epoch ' || {_FORMAT.format(v="x")} ELSE '' END || CASE WHEN kind <> 1 THEN ' | grad ' || {_FORMAT.format(v="g")} ELSE '' END
        || CASE WHEN kind = 2 THEN ' | reward | chosen ' || {_FORMAT.format(v="x")} || ' | rejected ' || {_FORMAT.format(v="g")} || ' | margin ' || {_FORMAT.format(v="m")} || ' | accuracy ' || {_FORMAT.format(v="a")}
              WHEN kind = 1 THEN ' | components | hard ' || {_FORMAT.format(v="g")} ELSE '' END AS line
    FROM u WHERE x IS NOT NULL AND NOT isnan(x)
    """
)
def log_line_parts(spark, sf_dir):
    """Epoch, gradient, reward and component parts, made from the logged loss."""
    x, kind = F.col("x"), F.col("log_id") % 3
    rows = table(spark, sf_dir, "train_log").select("log_id", "stage", "step", "max_steps", F.try_element_at("logs", F.lit("loss")).alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
    made = lambda **kv: F.map_from_arrays(F.array(*(F.lit(k.replace("__", "/")) for k in kv)), F.array(*kv.values()))
    parts = (
        F.when(kind == 0, made(grad_norm=x * 3))
        .when(kind == 1, F.map_concat(made(epoch=x), made(loss__hard=x * 3)))
        .otherwise(made(epoch=x, grad_norm=x * 3, rewards__chosen=x, rewards__rejected=x * 3, rewards__margins=x / 7, rewards__accuracies=1 / (1 + x), loss__hard=x))
    )
    rows = rows.withColumn("logs", parts)  # a column of its own: the line reads it many times
    return rows.select("log_id", logs.log_line(F.col("stage"), F.col("step"), F.col("max_steps"), F.col("logs")).alias("line"))


_NAMES = "n AS (SELECT concat_ws('/', 'runs', coalesce(run_name, 'none'), doc_type, doc_id || CASE WHEN doc_id % 3 = 0 THEN '.json' ELSE '.txt' END) AS path, doc_id FROM documents WHERE doc_type IS NOT NULL)"


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ending = F.when(F.col("doc_id") % 3 == 0, ".json").otherwise(".txt")
    path = F.concat_ws("/", F.lit("runs"), F.coalesce("run_name", F.lit("none")), "doc_type", F.concat(F.col("doc_id").cast("string"), ending))
    return table(spark, sf_dir, "documents").where("doc_type IS NOT NULL").select(path.alias("path"), "doc_id")


@query(
    f"WITH {_NAMES} SELECT DISTINCT path FROM n WHERE (path LIKE 'runs/%.json' AND len(string_split(path, '/')) = 4) OR (path LIKE 'runs/none/%/1%' AND len(string_split(path, '/')) = 4) OR regexp_full_match(path, '.*/[^/]?7[.]txt')"
)
def glob_matches(spark, sf_dir):
    """Files that match any of several patterns, each once."""
    return artifacts.matching(_names(spark, sf_dir), ["runs/*/*/*.json", "runs/none/*/1*", "**/?7.txt", "**/7.txt"])


@query(f"WITH {_NAMES} SELECT doc_id AS ordinal, path FROM n WHERE path NOT IN (SELECT path FROM n WHERE doc_id % 5 <> 0)")
def required_missing(spark, sf_dir):
    """Required files that aren't there, in their configured order."""
    names = _names(spark, sf_dir)
    return artifacts.missing_of(names.withColumnRenamed("doc_id", "ordinal"), names.where("doc_id % 5 <> 0")).select("ordinal", "path")


@query(f"WITH {_MANIFEST}, d AS (SELECT * FROM m JOIN documents ON doc_id = ordinal) SELECT doc_type AS run_name, row_number() OVER (PARTITION BY doc_type ORDER BY ordinal) - 1 AS ordinal, path, size_bytes, sha256 FROM d WHERE doc_type IS NOT NULL")
def manifest_entries(spark, sf_dir):
    """Entries of manifests kept as JSON text, one for each document type."""
    rows = _manifest(spark, sf_dir).where("path LIKE '%/%'").select(F.split_part("path", F.lit("/"), F.lit(1)).alias("run_name"), F.struct("ordinal", "path", "size_bytes", "sha256").alias("f"))
    files = rows.groupBy("run_name").agg(F.transform(F.sort_array(F.collect_list("f")), lambda x: x.dropFields("ordinal")).alias("files"))
    return artifacts.manifest_entries(files.select(F.to_json(F.struct("run_name", "files")).alias("manifest"))).withColumn("ordinal", F.col("ordinal").cast("bigint"))


@query("SELECT 'run/' || doc_id AS key, 'upload' AS action FROM documents WHERE lang = 'de' UNION ALL (SELECT 'run/' || doc_id, 'delete' FROM documents WHERE doc_id % 2 = 0 AND lang IS DISTINCT FROM 'de')")
def push_plan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.concat_ws("/", F.lit("run"), F.col("doc_id").cast("string")).alias("key"), "doc_id", "lang")
    return artifacts.push_plan(docs.where("doc_id % 2 = 0"), docs.where("lang = 'de'"), True)


@query(f"WITH {_NAMES} SELECT path AS key FROM n")
def pull_plan(spark, sf_dir):
    """Keys to download: the folders' markers, and repeated keys, don't count."""
    names = _names(spark, sf_dir).select(F.col("path").alias("key"))
    return artifacts.pull_plan(names.unionByName(names.select(F.regexp_replace("key", "[^/]+$", "").alias("key"))).unionByName(names))


_URIS = "u AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'http://' ELSE 's3://' END || coalesce(source, '') || CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '/' || doc_type ELSE '//' || doc_type || '/' END AS uri FROM documents)"


@query(f"WITH {_URIS}, v AS (SELECT doc_id, regexp_extract(uri, '^s3://([^/]+)', 1) AS bucket, regexp_extract(uri, '^s3://[^/]+/*([^/]*)', 1) AS name FROM u) SELECT doc_id, CASE WHEN bucket <> '' THEN bucket END AS bucket, CASE WHEN bucket <> '' THEN name || CASE WHEN name <> '' THEN '/' ELSE '' END END AS prefix FROM v")
def object_folders(spark, sf_dir):
    """Bucket and prefix of object store URIs; null where they are none."""
    i = F.col("doc_id") % 3
    end = F.when(i == 0, "").when(i == 1, F.concat(F.lit("/"), "doc_type")).otherwise(F.concat(F.lit("//"), F.col("doc_type"), F.lit("/")))
    uri = F.concat(F.when(F.col("doc_id") % 7 == 0, "http://").otherwise("s3://"), F.coalesce("source", F.lit("")), end)
    return table(spark, sf_dir, "documents").select("doc_id", artifacts.folder_of(uri).alias("f")).select("doc_id", "f.bucket", "f.prefix")


@query("SELECT doc_id, strftime(created_at, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(created_at) % 1000000 = 0 THEN '' ELSE '.' || lpad((epoch_us(created_at) % 1000000)::VARCHAR, 6, '0') END || '+00:00' AS created FROM documents")
def utc_times(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.utc_iso(F.col("created_at")).alias("created"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
