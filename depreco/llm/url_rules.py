"""URL filters by association rules.

A fixed list of host and path rules judges what it covers. Those judged URLs are the labels from which
Spark's FP-growth mines combinations of URL tokens that go with a verdict; rules that pass a support and
a confidence bound judge the other URLs.

Tokens that occur in exactly the same judged URLs are one item to the miner: any choice of them has the same
support and confidence, so mining them one by one would only write each rule down for every choice. A long URL,
alone or on many rows, is thus a few items. What is left of the growth is the number of item combinations of
different support, as in any frequent-itemset mining. A rule matches a URL that has a token of each of its items,
and stands for the longest of its choices, all tokens of the URL in those items. Rules are held in an inverted
index under the rarest item of each, and URLs look up their items there.

Among the mined rules that match, the one of highest confidence wins, then the longer, then the one of
larger support, then block before allow, then the first by its tokens. URLs that no rule matches are
allowed.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from
there up to ``?``, ``#`` or the end. A null URL or one without ``://`` has neither (both empty), no
tokens, and is allowed. Repeated rows are judged each. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Scratch

#: (verdict, host, path): the list of the contract.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
SUPPORT = 0.001  # share of the judged URLs that must hold a rule's tokens and verdict
CONFIDENCE = 0.9
_ALLOW, _BLOCK = "=allow", "=block"


def fold(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, url, host, path) of each row."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), rest.alias("rest"))
    host = fold(F.regexp_extract("rest", r"\A([^/?#]*)", 1))
    path = F.regexp_extract("rest", r"\A[^/?#]*([^?#]*)", 1)
    return rows.select("page_id", "rest", host.alias("host"), path.alias("path"))


def listed(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fixed rule that fits, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, of, under in sorted(rules, key=lambda r: len(r[1] + r[2])):  # longer rules replace shorter
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(under)
        rule, verdict = F.when(fits, of + under).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def tokens(host: Column, path: Column, rest: Column) -> Column:
    """Distinct tokens of a URL: host labels, path words, file kind and query names, each with its place.

    Numbers say nothing of their own and count as one token per place."""
    name = lambda x: F.regexp_replace(x, "[0-9]+", "0")
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), name(x)))
    words = F.transform(F.split(path, "[/._-]+"), lambda x: F.concat(F.lit("p:"), name(x)))
    query = F.regexp_extract(rest, r"\A[^?#]*\?([^#]*)", 1)
    names = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), name(F.regexp_extract(x, r"\A([^=]*)", 1))))
    found = F.filter(F.concat(labels, words, names), lambda x: F.char_length(x) > 2)
    return F.sort_array(F.array_distinct(found))


def items_of(judged: DataFrame) -> DataFrame:
    """(token, item): the tokens of the judged URLs; those in exactly the same URLs share an item, named by its first.

    What a token occurs in is told by the number of its distinct token sets and two 64-bit hashes of them, each
    combined by exclusive or, in one aggregate with a map-side part."""
    held = judged.select("items").distinct().select(F.explode("items").alias("token"), F.xxhash64(F.lit(1), "items").alias("a"), F.xxhash64(F.lit(2), "items").alias("b"))
    marks = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    first = marks.groupBy("n", "a", "b").agg(F.min("token").alias("item"))
    return marks.join(first, ["n", "a", "b"]).select("token", "item")


def mine(judged: DataFrame, items: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(need, verdict, confidence, support): the rules "these items, so this verdict" that pass both
    bounds, from ``judged`` (items, verdict) and what :func:`items_of` gives for it."""
    sets = judged.select("items").distinct()
    named = sets.select("items", F.explode("items").alias("token")).join(items, "token").groupBy("items").agg(F.sort_array(F.collect_set("item")).alias("held"))
    label = F.when(F.col("verdict") == "block", _BLOCK).otherwise(_ALLOW)
    baskets = judged.select("items", label.alias("label")).join(named, "items").select(F.concat("held", F.array("label")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.filter(F.col("consequent")[0].isin(_ALLOW, _BLOCK))
    rules = rules.select(F.sort_array("antecedent").alias("need"), F.substring(F.col("consequent")[0], 2, 10).alias("verdict"), "confidence", "support")
    return rules.filter(~F.exists("need", lambda x: x.isin(_ALLOW, _BLOCK)))


def judge(pages: DataFrame, rules: tuple = RULES, support: float = SUPPORT, confidence: float = CONFIDENCE, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, mined) of each row; ``mined`` holds the tokens of the mined
    rule that judged the URL, null where none did."""
    scratch = Scratch(pages.sparkSession)
    rows = parts(pages, id_col, url_col)
    rule, verdict = listed(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), tokens(F.col("host"), F.col("path"), F.col("rest")).alias("items"))
    rows = scratch.keep(rows)
    judged = rows.filter("verdict is not null and size(items) > 0")
    session = rows.sparkSession
    mined = session.createDataFrame([], "need array<string>, verdict string, confidence double, support double")
    known = session.createDataFrame([], "token string, item string")
    if not judged.isEmpty():
        known = scratch.keep(items_of(judged))
        mined = scratch.keep(mine(judged, known, support, confidence))
    # URLs of equal tokens are judged once.
    open_ = rows.filter("verdict is null").select("items").distinct()
    own = open_.select("items", F.explode("items").alias("token")).join(known, "token").groupBy("items").agg(F.collect_list(F.struct("item", "token")).alias("own"))
    looked = own.select("items", "own", F.explode(F.array_distinct("own.item")).alias("item"))
    seen = looked.groupBy("item").agg(F.count("*").alias("n"))
    spread = mined.select("need", "verdict", "confidence", "support", F.explode("need").alias("item")).join(seen, "item")
    index = spread.groupBy("need", "verdict", "confidence", "support").agg(F.min_by("item", F.struct("n", "item")).alias("item"))
    hits = looked.join(index, "item").filter(F.size(F.array_except("need", F.col("own.item"))) == 0)
    tokens_held = F.sort_array(F.transform(F.filter("own", lambda x: F.array_contains(F.col("need"), x["item"])), lambda x: x["token"]))
    hits = hits.select("items", "verdict", "confidence", "support", tokens_held.alias("need"))
    order = F.struct(-F.col("confidence"), -F.size("need"), -F.col("support"), F.col("verdict") != "block", F.col("need"))
    best = hits.groupBy("items").agg(F.min_by(F.struct("verdict", "need"), order).alias("best"))
    best = best.select("items", F.col("best.verdict").alias("found"), F.col("best.need").alias("mined"))
    out = rows.join(best, "items", "left")
    free = F.col("verdict").isNull()
    return scratch.finish(out.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "found", F.lit("allow")).alias("verdict"), F.when(free, F.col("mined")).alias("mined"),
    ))
