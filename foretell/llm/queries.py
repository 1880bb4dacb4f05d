"""The registered queries of this subpackage, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.llm import (
    bpe,
    chat,
    counts,
    decontaminate,
    minhash,
    packing,
    pii,
    quality,
    repair,
    runs,
    spotsigs,
    toxicity,
    urls,
)
from foretell.llm.common import remainder, table

VOCABULARY = "word_bpe_49k.json"
#: Its token for the end of a text.
END_OF_TEXT = 49407
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_groups(table(spark, folder, "documents"), width=2)


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY), limit=2048)


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(
        table(spark, folder, "documents"),
        public_tokenizers.path(VOCABULARY),
        row_length=2048,
        eos=END_OF_TEXT,
        pad=END_OF_TEXT,
    )


def op4_spotsigs(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.edited_fingerprints(table(spark, folder, "documents"))


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), RULES)


def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 5) == 0
    scores = quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    trap = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(trap).alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    rows = rows.withColumn("parts", F.array(chat.text_part(F.col("text"))))
    out = chat.format_conversations(rows)
    read = out.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 3) == 1
    scores = toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"), ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = repair.damaged(table(spark, folder, "conversations"))
    return repair.summaries(rows, present=F.col("present"))


def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    return runs.run_digests(table(spark, folder, "documents"), repeat=True)


def op13_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pii_digests(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_minhash,
        op2_token_counts,
        op3_packing,
        op4_spotsigs,
        op5_url_filter,
        op6_bpe,
        op7_quality,
        op8_chat,
        op9_decontaminate,
        op10_toxicity,
        op11_repair,
        op12_runs,
        op13_pii,
    )
}

def _edit(letter: str, state: str, cost: str = "0", row: str = "''", when: str = "true") -> str:
    """SQL of a state behind one more edit: cost, audit and repaired rows so far."""
    return (
        f"CASE WHEN {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {state}.t || {row}}}"
        " ELSE {'c': 1000000000::BIGINT, 'a': '', 't': ''} END"
    )


def _repair_sql() -> str:
    """Cheapest and least audits row by row, for each state of the grammar."""
    delete = [_edit("D", f"s{n}", "2") for n in range(4)]
    kept = "chr(10) || role || ':' || text"

    def stays(letter: str, state: int, to: str) -> str:
        if letter == "K":
            return _edit("K", f"s{state}", "late", kept, f"NOT gone AND left(role, 1) = '{to}'")
        name = {"u": "user", "a": "assistant"}[to]
        return _edit("R", f"s{state}", "late + 1", f"chr(10) || '{name}:' || text", "NOT gone")

    user = [stays(letter, state, "u") for letter in "KR" for state in (0, 1, 3)]
    insert_user = [_edit("I", f"s{n}", "5", "chr(10) || 'user:'") for n in (0, 1, 3)]
    insert_assistant = _edit("I", "s2", "5", "chr(10) || 'assistant:'")

    def closed(source: str) -> str:
        return f"""SELECT conv_id, i, s0, s1, s2, least(s3, {insert_assistant}) AS s3
            FROM (SELECT conv_id, i, s0, s1, least(s2, {", ".join(insert_user)}) AS s2, s3 FROM ({source}))"""

    none = "{'c': 1000000000::BIGINT, 'a': '', 't': ''}"
    start = f"SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, {none} AS s1, {none} AS s2, {none} AS s3 FROM convs"
    step = f"""SELECT conv_id, rows.i, {delete[0]} AS s0, least({delete[1]}, {stays("K", 0, "s")}) AS s1,
            least({", ".join([delete[2], *user])}) AS s2,
            least({delete[3]}, {stays("K", 2, "a")}, {stays("R", 2, "a")}) AS s3
            FROM steps JOIN rows USING (conv_id) WHERE rows.i = steps.i + 1"""
    blanks = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""
        WITH RECURSIVE dealt AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
                list_prepend(4294967295::UBIGINT, list_transform(
                    string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda l: ord(l)::UBIGINT)),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda y, z: xor(y >> 1, (y & 1) * 3988292384::UBIGINT))), 4294967295::UBIGINT) % 20 AS kind
            FROM conversations
        ), damaged AS (
            SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM dealt
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i
            FROM damaged
        ), judged AS (
            SELECT *, rtrim(text, {blanks}) AS said,
                row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
                lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
            FROM numbered
        ), rows AS (
            SELECT *, CASE WHEN said = '' THEN 'blank' WHEN again THEN 'duplicate'
                    WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                fault IN ('blank', 'duplicate') AS gone, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS late
            FROM judged
        ), convs AS (SELECT DISTINCT conv_id FROM conversations),
        steps AS ({closed(start)} UNION ALL {closed(step)}),
        counted AS (
            SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM rows GROUP BY conv_id
        ), ends AS (
            SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
                coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, least(s0, s3) AS s
            FROM convs c LEFT JOIN counted USING (conv_id) JOIN steps USING (conv_id) WHERE i = coalesce(n, 0)
        )
        SELECT conv_id, gaps, blank, duplicate, truncated, illegal, s.c AS cost, s.a AS audit,
            sha256(substr(s.t, 2)) AS repaired_sha256
        FROM ends
    """


ORACLES: dict[str, str] = {
    # all pairs of texts that share a shingle; components by spreading the smallest id
    "op1_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN [w[1]]
                ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
            FROM words
        ), sizes AS (SELECT doc_id, len(s) AS n FROM sets),
        shingles AS (SELECT doc_id, unnest(s) AS x FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
            JOIN sizes sa ON sa.doc_id = a.doc_id JOIN sizes sb ON sb.doc_id = b.doc_id
            WHERE 5 * least(sa.n, sb.n) >= 4 * greatest(sa.n, sb.n)
            GROUP BY a.doc_id, b.doc_id
            HAVING 100 * count(*) >= 80 * (min(sa.n) + min(sb.n) - count(*))
        ), reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
        )
        SELECT s.doc_id, s.n AS n_shingles, min(r.b) AS component_id, s.doc_id = min(r.b) AS kept
        FROM sizes s JOIN reached r ON r.a = s.doc_id GROUP BY s.doc_id, s.n
    """,
    "op8_chat": r"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), told AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                sum(length('<|turn|><|text|><|end|>') + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
                    + length(replace(replace(text, '\', '\\'), '<|', '<\|')))::BIGINT AS formatted_chars
            FROM rows GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
            sha256(loss) AS loss_sha256, formatted_chars
        FROM told
    """,
    # the least audits of a state's prefixes lead to its least whole ones: none is a prefix of another
    "op11_repair": _repair_sql(),
}
