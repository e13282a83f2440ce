"""One query for each operator, over its whole table with production settings, and the SQL it is checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact_dedup, jaccard_join, languages, line_cleaning, mixing, packing, passages, periodic_runs, prefix_trie, pseudonyms,
    secret_scan, syncmers, toxicity,
)
from .common import SPACE, WORD, importable, small_batches, whole_text, written

#: For these queries only; a deployment passes its own secret key.
PSEUDONYM_KEY = b"key of the registered query"

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer() -> str:
    """The vocabulary file of the packed sequences."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(documents(spark, sf_dir), carry=["doc_id"]))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.groups(documents(spark, sf_dir), carry=["doc_id"])
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(documents(spark, sf_dir), PSEUDONYM_KEY, carry=["doc_id"]).select(
        "row.doc_id", "text", *(f"n_{kind}" for kind in pseudonyms.NAMES)
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(documents(spark, sf_dir), table(spark, sf_dir, "labels"), carry=["doc_id"])
    return scored.select("row.doc_id", "held_out", "score", "predicted")


def op7_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans are listed as start:end in words, the end exclusive."""

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(spans)

    def words(spans: str) -> Column:
        return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])

    marked = passages.mark(documents(spark, sf_dir), carry=["doc_id"])
    return marked.select(
        "row.doc_id",
        F.size("passages").cast("long").alias("n_passages"),
        words("passages").alias("shared_words"),
        words("copies").alias("copied_words"),
        listed("passages"),
        listed("copies"),
    )


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer())


def op9_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = syncmers.with_next(documents(spark, sf_dir), carry=["doc_id"])
    rows = rows.withColumn("edited", syncmers.edited(F.col("text"), F.col("next_text")))
    rows = syncmers.with_distinct(rows, "edited", "edited_anchors")
    own = ("text", "anchors")
    rows = syncmers.with_near(rows, own, ("edited", "edited_anchors"), "near_edited")
    rows = syncmers.with_near(rows, own, ("next_text", "next_anchors"), "near_next")
    return rows.select(
        "row.doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        syncmers.shown(syncmers.smallest(F.col("anchors"))).alias("fingerprint"),
        syncmers.shown(syncmers.smallest(F.col("edited_anchors"))).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op10_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = languages.identify(documents(spark, sf_dir), carry=["doc_id"])
    return found.select("row.doc_id", "held_out", "lang_pred", "score", "mixture")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Each conversation with the first turns of the fifth conversation at or before it; how many, its id decides."""
    first = F.col("conv_id") - F.col("conv_id") % 5
    heads = turns.select(F.col("conv_id").alias("of"), F.col("turns").alias("head"))
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    taken = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), n)
    own = F.slice("turns", n + 1, F.size("turns"))
    return turns.join(heads, first == F.col("of"), "left").select("conv_id", F.concat(taken, own).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").withColumn("conv_id", F.col("conv_id").cast("long"))
    return prefix_trie.trie(rebuilt(written(prefix_trie.turns(conversations))))


def op12_line_cleaning(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_cleaning.judge(documents(spark, sf_dir), carry=["doc_id"])
    return judged.select("row.doc_id", *(c for c in judged.columns if c not in ("row", "cleaned")))


def looped(docs: DataFrame) -> DataFrame:
    """The documents, those of which an id's hash is a multiple of ten with their words repeated from a place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split(whole_text(), f"{SPACE}+"), "")
    docs = docs.select("doc_id", whole_text().alias("text"), h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    docs = docs.withColumn("first", F.when(n > 0, g % n).cast("int"))
    docs = docs.withColumn("period", (1 + F.floor((n - F.col("first")) / (3 + g % 8))).cast("int"))
    unit = F.slice("words", F.col("first") + 1, F.col("period"))
    # Whole units, more than enough, and the words that the text has from the place on.
    rounds = F.flatten(F.array_repeat(unit, (F.floor((n - F.col("first")) / F.col("period")) + 1).cast("int")))
    repeated = F.concat(F.slice("words", F.lit(1), F.col("first")), F.slice(rounds, F.lit(1), n - F.col("first")))
    text = F.when(F.col("first").isNull(), F.col("text")).otherwise(F.array_join(repeated, " "))
    return docs.select("doc_id", text.alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(looped(documents(spark, sf_dir)), carry=["doc_id"])
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    order = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"], r["length"].alias("length")))
    best = F.array_min(order)
    exponent = F.floor(1000 * best["length"] / best["period"])
    return found.select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        exponent.alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP3_SQL = r"""
WITH plain AS (
    SELECT doc_id, COALESCE(text, '') AS text,
           regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
    FROM documents
), ranked AS (
    SELECT doc_id, bare,
           first_value(doc_id) OVER (PARTITION BY bare ORDER BY length(text) DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY bare) AS group_size
    FROM plain
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256
FROM ranked
"""

#: The crc32 of a number's digits, byte by byte and bit by bit; then nodes as prefixes, written out as joined digests.
OP11_SQL = r"""
WITH own AS (
    SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT DISTINCT conv_id, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, b: list_reduce(list_concat([xor(a, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                 lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
    )) % 9 AS h
    FROM own
), rebuilt AS (
    SELECT ids.conv_id, pos, role, text FROM ids JOIN own ON own.conv_id = ids.conv_id - ids.conv_id % 5 AND pos <= h
    UNION ALL
    SELECT conv_id, pos, role, text FROM ids JOIN own USING (conv_id) WHERE pos > h
), steps AS (
    SELECT conv_id, row_number() OVER turns AS depth, strlen(text) AS bytes,
           string_agg(sha256(length(role) || ':' || role || ':' || text), '') OVER turns AS key
    FROM rebuilt WINDOW turns AS (PARTITION BY conv_id ORDER BY pos)
), members AS (
    SELECT conv_id, 0 AS depth, 0 AS bytes, '' AS key FROM ids
    UNION ALL SELECT conv_id, depth, bytes, key FROM steps
), ended AS (
    SELECT depth, key, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
    FROM members JOIN (SELECT conv_id, max(depth) AS depth FROM members GROUP BY 1) USING (conv_id, depth) GROUP BY 1, 2
), nodes AS (
    SELECT depth, key, left(key, greatest(length(key) - 64, 0)) AS above, min(conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * max(bytes) AS saved
    FROM members GROUP BY 1, 2, 3
), children AS (
    SELECT depth - 1 AS depth, above AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2
), counted AS (
    SELECT nodes.*, COALESCE(n, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, key)
), subtrees AS (
    SELECT members.depth, members.key, sum(saved) AS saved, count(*) FILTER (WHERE n_children = 0) AS leaves
    FROM counted JOIN members ON members.conv_id = counted.conv_id AND members.depth <= counted.depth GROUP BY 1, 2
)
SELECT node.conv_id, node.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, node.n_convs,
       node.n_children::BIGINT AS n_children, leaves::BIGINT AS n_leaves, subtrees.saved::BIGINT AS saved_tokens,
       sha256(COALESCE(ids, '')) AS ends_sha256
FROM counted AS node
JOIN subtrees ON subtrees.depth = node.depth AND subtrees.key = node.key
LEFT JOIN nodes AS parent ON node.depth > 0 AND parent.depth = node.depth - 1 AND parent.key = node.above
LEFT JOIN ended ON ended.depth = node.depth AND ended.key = node.key
"""


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


#: The same rules over exploded lines and windows.
OP12_SQL = rf"""
WITH plain AS (
    SELECT row_number() OVER () AS row, doc_id, COALESCE(text, '') AS text,
           regexp_extract_all(COALESCE(text, ''), '{WORD}') AS words
    FROM documents
), windows AS (
    SELECT row, unnest(range(1, len(words) - 6)) AS place,
           unnest(list_transform(range(1, len(words) - 6), lambda i: array_to_string(words[i:i + 7], ' '))) AS text
    FROM plain WHERE len(words) >= 8
), seen AS (
    SELECT row, place, count(*) OVER (PARTITION BY row, text) AS n FROM windows
), repeated AS (
    SELECT row, count(DISTINCT word) AS n_repeat_words
    FROM (SELECT row, unnest(range(place, place + 8)) AS word FROM seen WHERE n > 1) GROUP BY 1
), all_lines AS (
    SELECT row, line FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM plain)
    WHERE regexp_matches(line, '{WORD}')
), lines AS (
    SELECT row, line, count(*) AS n, length(regexp_replace(line, '{SPACE}', '', 'g')) AS chars,
           len(regexp_extract_all(line, '{WORD}')) AS words,
           len(regexp_extract_all(line, {_quoted(line_cleaning.ITEM_BREAK)})) AS breaks,
           len(regexp_extract_all(line, {_quoted(line_cleaning.REPEATED_MARKS)})) AS marks,
           length(line) - length(translate(line, '{line_cleaning.SYMBOLS}', '')) AS symbols
    FROM all_lines GROUP BY 1, 2
), judged AS (
    SELECT *, CASE
        WHEN breaks >= 2 AND breaks * 6 >= words OR regexp_matches(line, {_quoted(line_cleaning.MENU_LINE)}) THEN 'navigation'
        WHEN regexp_matches(line, {_quoted(line_cleaning.NOTICE)}) THEN 'boilerplate'
        WHEN marks * 2 > words OR symbols * 100 > chars * {line_cleaning.MOST_SYMBOLS}
             OR NOT regexp_matches(line, {_quoted(line_cleaning.SENTENCE_MARK)}) THEN 'punctuation' END AS failed
    FROM lines
), summed AS (
    SELECT row, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines, sum((n - 1) * chars) AS lost_repeated,
           sum(chars) FILTER (WHERE failed = 'navigation') AS lost_navigation,
           sum(chars) FILTER (WHERE failed = 'boilerplate') AS lost_boilerplate,
           sum(chars) FILTER (WHERE failed = 'punctuation') AS lost_punctuation
    FROM judged GROUP BY 1
), counted AS (
    SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '{SPACE}', '', 'g'))::BIGINT AS word_chars,
           (length(text) - length(translate(text, '{line_cleaning.SYMBOLS}', '')))::BIGINT AS n_symbols,
           COALESCE(n_dup_lines, 0)::BIGINT AS n_dup_lines, COALESCE(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           COALESCE(n_lines, 0)::BIGINT AS n_lines, COALESCE(lost_navigation, 0)::BIGINT AS lost_navigation,
           COALESCE(lost_boilerplate, 0)::BIGINT AS lost_boilerplate,
           COALESCE(lost_punctuation, 0)::BIGINT AS lost_punctuation, COALESCE(lost_repeated, 0)::BIGINT AS lost_repeated
    FROM plain LEFT JOIN repeated USING (row) LEFT JOIN summed USING (row)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT base_failed AND (word_chars - lost_navigation - lost_boilerplate - lost_punctuation - lost_repeated) * 100
           >= word_chars * {line_cleaning.LEAST_KEPT} AS kept
FROM counted
"""


def queries() -> dict[str, Query]:
    return {
        "op1_secret_scan": op1_secret_scan,
        "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
        "op3_exact_dedup": op3_exact_dedup,
        "op4_pseudonyms": op4_pseudonyms,
        "op5_source_mixing": op5_source_mixing,
        "op6_toxicity": op6_toxicity,
        "op7_shared_passages": op7_shared_passages,
        "op8_best_fit_packing": op8_best_fit_packing,
        "op9_syncmer_fingerprints": op9_syncmer_fingerprints,
        "op10_language_mixture": op10_language_mixture,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_line_cleaning": op12_line_cleaning,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_exact_dedup": OP3_SQL, "op11_prefix_trie": OP11_SQL, "op12_line_cleaning": OP12_SQL}
