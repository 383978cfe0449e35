"""Quality rules with distribution divergence, in DataFrame operations only.

Base rules count words, symbols, repeated lines and repeated 8-word windows within each text. The verdict compares two
histograms of a document with those of its language over all documents, by the Jensen-Shannon distance (the
square root of the divergence in bits, 0 to 1): character classes, and the language's most common words with one bin for all other words. A comparison
counts only for texts that are long enough, and only where the language has a reference.

Words are hashed once (64 bits). A word's place among the common words is written as one character of an alphabet, so that a
document's histogram is a few string lengths. Repeated windows are found within the row: hashes of neighbours are joined to hashes of 2, 4 and
8 words, and only texts in which one of 8 repeats sort them. Nothing but the references is shuffled, and no text leaves its row, unless there are so many
languages that their references aren't broadcast: then documents meet them by language and salt.

A null text has no words and fails the base rules; a null lang has no reference, so its base verdict stands. Words that are equally
frequent rank by their text. Repeated rows are judged, and counted in the references, each for itself. A very long text is one array of words and
one of hashes. An empty table gives an empty table. Only doc_id, text and lang are read, so other columns can have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.llm.common import joined, stored

SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
#: Common words of a language: the most frequent ones, each at least 1 in 500 of its words; one character stands for each.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEF"
RARE = 500
MIN_REFERENCE_WORDS = 2000
#: Guards: texts below these sizes aren't compared.
MIN_CHARS, MIN_WORDS = 200, 40
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.50
#: Reference tables of so many languages at most (each under 4 KB) are broadcast.
BROADCAST_LANGS = 2000
CLASSES = ["upper", "letter", "digit", "space", "mark", "other"]


def _gone(text: str | Column, pattern: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(""))


def words(text: str) -> Column:
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPLIT), "")


def with_classes(rows: DataFrame) -> DataFrame:
    """rows (text) with counts of character classes, c_<class>."""
    rows = rows.withColumn("plain", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("bare", _gone("plain", r"[\p{L}\p{M}]+"))
    rows = rows.withColumns({"b1": _gone("bare", r"\p{Nd}+"), "b2": _gone("bare", SPLIT), "b3": _gone("bare", r"[.,;:!?'\"()\-]+")})
    n = F.length("bare")
    counts = {"upper": F.regexp_count("plain", F.lit(r"\p{Lu}")), "digit": n - F.length("b1"), "space": n - F.length("b2"), "mark": n - F.length("b3")}
    rows = rows.withColumns({f"c_{k}": v.cast("bigint") for k, v in counts.items()})
    rows = rows.withColumn("c_letter", (F.length("plain") - n - F.col("c_upper")).cast("bigint"))
    rows = rows.withColumn("c_other", (n - F.col("c_digit") - F.col("c_space") - F.col("c_mark")).cast("bigint"))
    return rows.drop("plain", "bare", "b1", "b2", "b3")


def references(docs: DataFrame, min_words: int = MIN_REFERENCE_WORDS) -> DataFrame:
    """lang, char_ref (shares by class), word_keys (hashes), word_ref (shares by word, then of all others), over all documents."""
    rows = docs.select("lang", "text").filter("lang is not null and text is not null")
    chars = with_classes(rows).groupBy("lang").agg(*(F.sum(f"c_{c}").alias(c) for c in CLASSES))
    all_chars = sum((F.col(c) for c in CLASSES), F.lit(0)).cast("double")
    chars = chars.select("lang", F.array(*(F.col(c) / all_chars for c in CLASSES)).alias("char_ref"), all_chars.alias("n_chars")).filter("n_chars > 0").drop("n_chars")
    counts = stored(rows.select("lang", F.explode(F.split("text", SPLIT)).alias("word")).filter("word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n")))
    total = counts.groupBy("lang").agg(F.sum("n").alias("total")).filter(F.col("total") >= min_words)
    common = counts.join(stored(total), "lang").filter((F.col("n") > 1) & (F.col("n") * RARE >= F.col("total")))
    top = common.withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word"))).filter(F.col("k") <= len(ALPHABET))
    lists = top.groupBy("lang", "total").agg(F.sort_array(F.collect_list(F.struct("k", "word", "n"))).alias("x"))
    share = F.transform("x", lambda s: s["n"] / F.col("total").cast("double"))
    rest = F.array((F.col("total") - F.aggregate("x", F.lit(0).cast("bigint"), lambda a, s: a + s["n"])) / F.col("total").cast("double"))
    keys = F.transform("x", lambda s: F.xxhash64(s["word"]))
    lists = lists.select("lang", keys.alias("word_keys"), F.concat(share, rest).alias("word_ref"))
    return chars.join(lists, "lang", "left")


def distance(counts: Column, shares: Column) -> Column:
    """Jensen-Shannon distance of a histogram of counts from one of shares of the same length."""
    n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    each = F.zip_with(counts, shares, lambda x, q: part(x / n, (x / n + q) / 2) + part(q, (x / n + q) / 2))
    return F.sqrt(F.greatest(F.aggregate(each, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)) / 2)


def _neighbours(h: str, step: int) -> Column:
    """Hashes of each element and the one `step` places on."""
    return F.zip_with(h, F.slice(h, step + 1, 1 << 30), lambda a, b: F.xxhash64(a, b))


def with_base(rows: DataFrame) -> DataFrame:
    """rows (text, words) with keys (hashes of the words), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns(
        {
            "n_words": F.size("words").cast("bigint"),
            "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
            "n_symbols": F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("bigint"),
            "lines": lines,
            "keys": F.transform("words", lambda w: F.xxhash64(w)),
        }
    )
    h, step = "keys", 1
    while step < WINDOW:
        rows = rows.withColumn(f"h{2 * step}", _neighbours(h, step))
        h, step = f"h{2 * step}", 2 * step
    # the last places have no whole window
    rows = rows.withColumn("h", F.slice(h, 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0)))).drop("h2", "h4", "h8")
    rows = rows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"))
    again = F.size(F.array_distinct("h")) < F.size("h")
    rows = rows.withColumn("s", F.when(again, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))))
    twin = F.transform("s", lambda x, i: F.when((x["h"] == F.get("s", i - 1)["h"]) | (x["h"] == F.get("s", i + 1)["h"]), x["p"]))
    rows = rows.withColumn("p", F.sort_array(F.array_compact(twin)))
    covered = F.transform("p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW))))
    rows = rows.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint"))
    return rows.drop("lines", "h", "s", "p")


def judge(docs: DataFrame, min_reference_words: int = MIN_REFERENCE_WORDS, reference_docs: DataFrame | None = None) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, both distances, and whether each comparison was made, for each row of docs.

    char_test and word_test: made, short (the text is below the guard), or no reference (no language, or one with too little text in
    reference_docs, which are docs unless given; a fixed set of them makes verdicts independent of what else is judged).
    """
    refs = stored(references(docs if reference_docs is None else reference_docs, min_reference_words))
    small = refs.count() <= BROADCAST_LANGS
    rows = joined(docs.select("doc_id", "text", "lang"), refs, ["lang"], small, "left")
    rows = with_base(rows.withColumn("words", words("text")))
    coded = F.transform("keys", lambda w: F.substring(F.lit("-" + ALPHABET), F.array_position("word_keys", w).cast("int") + 1, F.lit(1)))
    rows = rows.withColumn("coded", F.array_join(coded, "")).drop("words", "keys")
    rows = with_classes(rows)
    word_counts = [F.length("coded") - F.length(F.replace("coded", F.lit(c))) for c in "-" + ALPHABET]
    rows = rows.withColumn("in_list", F.array(*(x.cast("double") for x in word_counts[1:]))).withColumn("not_in_list", F.array(word_counts[0].cast("double")))
    rows = rows.withColumn("word_hist", F.concat(F.slice("in_list", 1, F.size("word_keys")), F.col("not_in_list")))
    rows = rows.withColumn("char_hist", F.array(*(F.col(f"c_{c}").cast("double") for c in CLASSES)))
    long = {"char": F.coalesce(F.length("text"), F.lit(0)) >= MIN_CHARS, "word": F.col("n_words") >= MIN_WORDS}
    tests = {f"{k}_test": F.when(~x, "short").when(F.col(f"{k}_ref").isNull(), "no reference").otherwise("made") for k, x in long.items()}
    rows = rows.withColumns(tests)
    by_char = F.when(F.col("char_test") == "made", distance(F.col("char_hist"), F.col("char_ref")))
    by_word = F.when(F.col("word_test") == "made", distance(F.col("word_hist"), F.col("word_ref")))
    rows = rows.withColumns({"char_distance": F.round(by_char, 6), "word_distance": F.round(by_word, 6)})
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    near = (F.coalesce("char_distance", F.lit(0.0)) <= MAX_CHAR_DISTANCE) & (F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & near).alias("kept"), "char_distance", "word_distance", "char_test", "word_test")


def oracle() -> str:
    """DuckDB SQL for judge()."""
    classes = ", ".join(f"sum(c_{c})" for c in CLASSES)
    counts = ", ".join(f"CAST(c_{c} AS DOUBLE)" for c in CLASSES)

    def jsd(p: str, q: str) -> str:
        def part(x: str, i: str, m: str) -> str:
            return f"CASE WHEN {x}[{i}] > 0 THEN {x}[{i}] * log2({x}[{i}] / {m}) ELSE 0e0 END"

        m = f"(({p}[i] + {q}[i]) / 2)"
        return f"sqrt(greatest(list_sum(list_transform(range(1, len({p}) + 1), lambda i: {part(p, 'i', m)} + {part(q, 'i', m)})), 0e0) / 2)"

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, text, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws FROM documents),
b AS (SELECT *, regexp_replace(t, '[\\p{{L}}\\p{{M}}]+', '', 'g') AS bare, len(ws) AS n_words, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
c AS (SELECT *, len(regexp_extract_all(t, '\\p{{Lu}}')) AS c_upper, length(bare) - length(regexp_replace(bare, '\\p{{Nd}}+', '', 'g')) AS c_digit, length(bare) - length(regexp_replace(bare, '[\\x20\\x09-\\x0D]+', '', 'g')) AS c_space,
  length(bare) - length(regexp_replace(bare, '[.,;:!?''"()\\-]+', '', 'g')) AS c_mark FROM b),
e AS (SELECT *, length(t) - length(bare) - c_upper AS c_letter, length(bare) - c_digit - c_space - c_mark AS c_other FROM c),
cr AS (SELECT lang, list_transform([{classes}], lambda x: x / CAST(list_sum([{classes}]) AS DOUBLE)) AS char_ref FROM e WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY lang HAVING list_sum([{classes}]) > 0),
tot AS (SELECT lang, sum(n_words) AS total FROM e WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY lang HAVING sum(n_words) >= {MIN_REFERENCE_WORDS}),
wc AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(ws) AS word FROM e WHERE lang IS NOT NULL) u GROUP BY ALL),
tp AS (SELECT lang, word, n, total, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS k FROM wc JOIN tot USING (lang) WHERE n > 1 AND n * {RARE} >= total),
wr AS (SELECT lang, list(word ORDER BY k) AS word_list, list_append(list(n / CAST(total AS DOUBLE) ORDER BY k), (max(total) - sum(n)) / CAST(max(total) AS DOUBLE)) AS word_ref FROM tp WHERE k <= {len(ALPHABET)} GROUP BY lang),
w AS (SELECT rid, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM e WHERE len(ws) >= {WINDOW}) x),
r AS (SELECT rid, CAST(sum(least({WINDOW}, coalesce(nx - i, {WINDOW}))) AS BIGINT) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS m FROM w) y WHERE m > 1) z GROUP BY rid),
f AS (SELECT e.*, char_ref, word_list, word_ref, coalesce(r.n, 0) AS n_repeat_words, [{counts}] AS ch, list_transform(word_list, lambda x: CAST(len(list_filter(ws, lambda v: v = x)) AS DOUBLE)) AS wh FROM e LEFT JOIN cr USING (lang) LEFT JOIN wr USING (lang) LEFT JOIN r USING (rid)),
h AS (SELECT *, list_transform(ch, lambda x: x / nullif(list_sum(ch), 0)) AS cp, list_transform(list_append(wh, n_words - list_sum(wh)), lambda x: x / nullif(n_words, 0)) AS wp FROM f),
j AS (SELECT *, round(CASE WHEN length(text) >= {MIN_CHARS} AND char_ref IS NOT NULL THEN {jsd('cp', 'char_ref')} END, 6) AS char_distance, round(CASE WHEN n_words >= {MIN_WORDS} AND word_ref IS NOT NULL THEN {jsd('wp', 'word_ref')} END, 6) AS word_distance,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM h)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(char_distance, 0) <= {MAX_CHAR_DISTANCE} AND coalesce(word_distance, 0) <= {MAX_WORD_DISTANCE} AS kept, char_distance, word_distance,
  CASE WHEN length(t) < {MIN_CHARS} THEN 'short' WHEN char_ref IS NULL THEN 'no reference' ELSE 'made' END AS char_test, CASE WHEN n_words < {MIN_WORDS} THEN 'short' WHEN word_ref IS NULL THEN 'no reference' ELSE 'made' END AS word_test FROM j"""
