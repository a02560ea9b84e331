"""Personal data by bootstrapped contextual extraction (operator 8), native.

Base rules find emails, IP addresses, payment cards and phone numbers. Their
finds are the seeds: the two words before a find are a lexical pattern, and
patterns and the identifier-like tokens they introduce form a bipartite graph.
Such a token is a run of digit groups joined by blanks, dots, brackets or hyphens,
or else a blank-free token with a digit, outside base finds. Scores run over the
graph in rounds: a pattern's score is the mean score of its distinct tokens, a
token's score that of its best pattern. Tokens under patterns that reach
``MIN_SCORE`` with ``MIN_SEEDS`` distinct seeds are new finds of kind ``context``;
they are seeds too from then on, and rounds follow until no pattern brings new
ones. Scores are counts and means over all documents, combined before each
shuffle; only tokens and contexts are shuffled, never texts.

A null or empty text has no spans. Rows are told apart by id and text: repeated
rows give equal results. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from releaseflow.llm.components import saved
from releaseflow.llm.spans import SPAN, blanked, chunks, cut, find, pieces, searchable

KINDS = ("email", "ip", "card", "phone", "context")
ROUNDS, MIN_SCORE, MIN_SEEDS = 3, 0.8, 5
#: Characters before a token in which its pattern's words are sought first; the whole text before it comes last.
CONTEXT_CHARS = (64, 4096)
#: Stands for the characters of base finds where other tokens are sought.
_TAKEN = "\x03"

_EMAIL_CHAR = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:(?<!{_EMAIL_CHAR})|\G){_EMAIL_CHAR}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_GROUPS = r"[(\[]*+[0-9]++(?:[().\[\]-]++[0-9]++)*+[)\]]*+(?=[.,;:!?\"']*+(?:\s|\z))"
_TOKEN = (rf"(?<!\S)(?:{_GROUPS}(?:\x20(?:[.-]\x20)?+{_GROUPS})*+"
          rf"|[^\s0-9{_TAKEN}]*+[0-9](?:[^\s.,;:!?\"'{_TAKEN}]++|[.,;:!?\"']++(?=[^\s.,;:!?\"']))*+(?!{_TAKEN}))")
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IP = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        # Leading zeros are dropped first; of a part of zeros alone, one stays.
        return F.regexp_replace(match, r"(?<![0-9])0+(?=[0-9])", "").rlike(_IP)
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _checked(found: Column, kind: str) -> Column:
    return F.filter(found, lambda s: _valid(kind, s["text"]))


def _found(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, row, base, mentions)``: base spans sorted; these and other tokens with the words before them."""
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("row"),
                     searchable(F.col(text_col)).alias("clean"))
    rows = rows.select("*", *(pieces(F.col("clean"), p).alias(f"p_{k}") for k, p in _PATTERNS.items()))
    base = F.sort_array(F.concat(*(
        _checked(find(F.col(f"p_{k}"), k, n), k)
        for n, k in enumerate(KINDS[:4]))))
    # A generator's outputs are stored: the lists below are made once, not once per element that looks into them.
    rows = rows.select("id", "row", "clean", F.length("clean").alias("n"), F.inline(F.array(F.struct(
        base.alias("base"), chunks(F.col("clean")).alias("parts")))))
    free = F.when(F.size("base") > 0, blanked(F.col("parts"), F.col("n"), F.col("base"), _TAKEN)).otherwise(F.col("clean"))
    rows = rows.select("*", F.inline(F.array(F.struct(pieces(free, _TOKEN).alias("p_token")))))

    def mention(span: Column, seed: bool) -> Column:
        return F.struct(span.alias("span"), F.lit(seed).alias("seed"),
                        F.lower(_words_before(F.col("parts"), span["start"])).alias("words"))

    mentions = F.concat(F.transform("base", lambda s: mention(s, True)),
                        F.transform(find(F.col("p_token"), "context", 4), lambda s: mention(s, False)))
    return rows.select("id", "row", "base", mentions.alias("mentions"))


def _words_before(parts: Column, start: Column) -> Column:
    """The two words before a place of a text in chunks, or an empty text."""
    def sought(chars: Column) -> Column:
        n = F.least(start, chars)
        before = F.concat(F.when(n == start, F.lit(" ")).otherwise(F.lit("")), cut(parts, start - n, n))
        return F.get(F.regexp_extract_all(before, F.lit(r"\s(\S++\s++\S++)\s++$"), F.lit(1)), F.lit(0))

    return F.coalesce(*(sought(F.lit(n)) for n in CONTEXT_CHARS), sought(start), F.lit(""))


def _pattern_scores(edges: DataFrame) -> DataFrame:
    """``(words, score, seeds)`` after ``ROUNDS`` rounds over ``(words, token, seed)``."""
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    for k in range(ROUNDS):
        words = scored.groupBy("words").agg(F.avg("score").alias("score"),
                                            F.sum(F.col("seed").cast("int")).alias("seeds"))
        if k == ROUNDS - 1:
            return words
        lifted = edges.join(words, "words").groupBy("token").agg(
            F.max(F.when(F.col("seeds") >= MIN_SEEDS, F.col("score")).otherwise(0.0)).alias("best"))
        scored = edges.join(lifted, "token").withColumn(
            "score", F.when(F.col("seed"), 1.0).otherwise(F.col("best")))
    raise AssertionError


def _good_patterns(edges: DataFrame) -> DataFrame:
    """``(words)`` of the patterns that introduce identifiers, when no more are found."""
    able = edges.groupBy("words").count().filter(F.col("count") >= MIN_SEEDS).select("words")
    edges = saved(edges.join(able, "words", "left_semi"))
    while True:
        # Patterns with fewer seeds give their tokens no score.
        live = edges.groupBy("words").agg(F.count_if("seed").alias("seeds")).filter(F.col("seeds") >= MIN_SEEDS)
        near = saved(edges.join(live, "words", "left_semi"))
        good = saved(_pattern_scores(near).filter(F.col("score") >= MIN_SCORE).select("words"))
        new = saved(near.filter("not seed").join(good, "words", "left_semi").select("token").distinct())
        if new.isEmpty():
            return good
        known = new.withColumn("found", F.lit(True))
        edges = saved(edges.join(known, "token", "left").select(
            "words", "token", (F.col("seed") | F.col("found").isNotNull()).alias("seed")))


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, base, spans)``: sorted base spans, and those with what the patterns add."""
    found = saved(_found(df, id_col, text_col))
    tokens = (found.select("row", F.explode("mentions").alias("m"))
              .select("row", "m.span", "m.seed", "m.words", F.col("m.span.text").alias("token"))
              .filter("words != ''"))
    edges = tokens.groupBy("words", "token").agg(F.max("seed").alias("seed"))
    good = _good_patterns(edges)
    new = (tokens.filter("not seed").join(good, "words", "left_semi")
           .groupBy("row").agg(F.collect_set("span").alias("more")))
    spans = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast(f"array<{SPAN}>"))))
    return found.join(new, "row", "left").select(F.col("id").alias(id_col), "base", spans.alias("spans"))
