"""Secret scans through a trigram inverted index; DataFrame expressions only.

1. Each rule's regular expression is reduced to a Boolean trigram query: an OR over its
   alternatives, each an AND of the trigrams that any match must contain.
2. The index: for every trigram of those queries, a posting (trigram, row) per text that
   contains it, case folded.  Postings are staged in the shared folder.
3. Postings are intersected per row: the rules whose query holds are its candidates.
4. Candidate rules are verified by their regular expression; a rule with an alternative
   that has no mandatory trigram (long hex strings) scans every text.

Spans are in code points, end exclusive.  Matches of one kind are leftmost and do not
overlap; matches that fail the rule's length test are dropped after matching.

Rows are identified by (doc_id, hash of the text), so repeated rows get the same result
each; null text is an empty text; empty tables give no rows; very long texts are one row
like any other.  Further columns pass through ``masked`` and are dropped by ``scanned``.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, whole_row


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``pattern`` is what Spark's (Java) regular expressions run."""
    kind: str
    pattern: str
    any_case: bool = False
    group: int = 0          # the group whose length is tested
    least: int = 1          # fewest code points of that group
    direct: str = ""        # same matches with the length built in, where that is possible


BLOCK = 64      # matches or spans of one walk

# Base rules (fixed values of the contract).
BASE = (
    Rule("assign", "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         any_case=True, group=2, least=12),
    Rule("access", "AKIA[A-Z0-9]+", least=18),
    Rule("hex", "[0-9a-f]+", least=16, direct="[0-9a-f]{16,}"),  # runs are maximal
)
# Kinds that the method adds (published formats of well-known credentials).
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("git_host", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps", "AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]+"),
    Rule("login_url", "[A-Za-z][A-Za-z0-9+.-]{1,15}://[^/\\x00-\\x20:@]{1,64}:[^/\\x00-\\x20:@]{1,64}@"),
)
RULES = BASE + MORE
MAX_ALTERNATIVES = 64
SMALL_CLASS = 8


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of a regular expression, each the set of trigrams (lower case) that
    any match of it contains.  An empty set means: no mandatory trigram, scan fully."""

    def expand(nodes) -> list[list[str]]:
        # an alternative is a list of literal runs; "" ends it where the run may not go on
        alts: list[list[str]] = [[""]]
        for op, arg in nodes:
            if op is sre.LITERAL:
                options = [[chr(arg)]]
            elif op is sre.IN and len(arg) <= SMALL_CLASS and all(o is sre.LITERAL for o, _ in arg):
                options = [[chr(c)] for _, c in arg]
            elif op is sre.BRANCH:
                options = [a for branch in arg[1] for a in expand(branch)]
            elif op is sre.SUBPATTERN:
                options = expand(arg[-1])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
                low, high, inner = arg
                options = [[""], *expand(inner)] if (low, high) == (0, 1) else [["", ""]]
                if low and (low, high) != (0, 1):
                    head = expand(inner)
                    options = [[*h, ""] for h in head] if len(head) <= SMALL_CLASS else [["", ""]]
            else:
                options = [["", ""]]
            if len(alts) * len(options) > MAX_ALTERNATIVES:
                options = [["", ""]]
            alts = [[*a[:-1], a[-1] + o[0], *o[1:]] for a in alts for o in options]
        return alts

    found = []
    for runs in expand(sre_parser.parse(pattern)):
        lowered = [r.lower() for r in runs]
        found.append(frozenset(r[i:i + 3] for r in lowered for i in range(len(r) - 2)))
    # an alternative that asks for more than another one adds nothing to the OR
    kept = dict.fromkeys(found)
    return [a for a in kept if not any(b < a for b in kept)]


def index_rules(rules: tuple[Rule, ...]) -> tuple[dict[str, list[frozenset[str]]], list[str]]:
    """Queries of the indexed rules, and the kinds that have to scan every text."""
    queries, full = {}, []
    for rule in rules:
        query = trigram_query(rule.pattern)
        if all(query):
            queries[rule.kind] = query
        else:
            full.append(rule.kind)
    return queries, full


def _row_key(df: DataFrame) -> DataFrame:
    return df.withColumn("s_text", F.coalesce("text", F.lit(""))).withColumn("s_key", F.xxhash64("s_text"))


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The inverted index: rows (s_tri, doc_id, s_key) for every trigram of the queries."""
    queries, _ = index_rules(rules)
    needed = sorted({t for query in queries.values() for alt in query for t in alt})
    folded = _row_key(docs.select("doc_id", "text")).withColumn("s_low", F.lower("s_text"))
    held = F.array_compact(F.array(*[
        F.when(F.contains("s_low", F.lit(t)), F.lit(i)) for i, t in enumerate(needed)]))
    return folded.select("doc_id", "s_key", F.explode(held).alias("s_tri"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows whose postings satisfy some rule's query, with the kinds to verify."""
    queries, _ = index_rules(rules)
    needed = sorted({t for query in queries.values() for alt in query for t in alt})
    ids = {t: i for i, t in enumerate(needed)}
    per_row = index.groupBy("doc_id", "s_key").agg(F.collect_set("s_tri").alias("s_held"))
    kinds = []
    for kind, query in queries.items():
        holds = F.lit(False)
        for alt in query:
            need = F.array(*[F.lit(ids[t]) for t in sorted(alt)])
            holds = holds | (F.size(F.array_except(need, F.col("s_held"))) == 0)
        kinds.append(F.when(holds, F.lit(kind)))
    return (per_row.select("doc_id", "s_key", F.array_compact(F.array(*kinds)).alias("s_kinds"))
            .where(F.size("s_kinds") > 0))


def _named(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _blocks(items: Column, walk: Callable[[Column], Column]) -> Column:
    """``walk`` over each run of ``BLOCK`` items.  Appending to an array or string copies it, so
    walks are kept short and their results are put together once."""
    last = F.floor((F.size(items) - 1) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: walk(F.slice(items, i * BLOCK + 1, BLOCK)))


def _spans(rule: Rule, at: int, text: Column) -> Column:
    """Array of (start, kind number, end, kind) of a rule's matches in ``text``.

    Splitting by the pattern gives the texts between the matches, so the lengths of both
    give the positions: first inside a block of matches, then blocks are moved to their place.
    """
    pattern = rule.direct or (f"(?i:{rule.pattern})" if rule.any_case else rule.pattern)
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda x: F.length(x))
    tests = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)), lambda x: F.length(x))
    parts = F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), tests.alias("test"))
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")

    def span(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(at).alias("number"), end.alias("end"),
                        F.lit(rule.kind).alias("kind"))

    def walk(block: Column) -> Column:
        return F.aggregate(block, F.struct(F.lit(0).alias("pos"), none.alias("found")), lambda acc, x: F.struct(
            (acc["pos"] + x["gap"] + F.coalesce(x["size"], F.lit(0))).alias("pos"),
            F.when(F.coalesce(x["test"] >= rule.least, F.lit(False)) & x["size"].isNotNull(), F.concat(
                acc["found"], F.array(span(acc["pos"] + x["gap"], acc["pos"] + x["gap"] + x["size"]))))
            .otherwise(acc["found"]).alias("found")))

    def joined(blocks: Column) -> Column:
        begins = F.aggregate(
            blocks, F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("at")),
            lambda acc, x: F.struct((acc["pos"] + x["pos"]).alias("pos"),
                                    F.concat(acc["at"], F.array(acc["pos"])).alias("at")),
            lambda acc: acc["at"])
        return F.flatten(F.zip_with(blocks, begins, lambda block, begin: F.transform(
            block["found"], lambda s: span(s["start"] + begin, s["end"] + begin))))

    return _named(parts, lambda p: _named(_blocks(p, walk), joined))


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows (s_whole: the row of ``docs``, doc_id, text, s_text, s_spans); spans sorted by
    start, then rule order."""
    _, full = index_rules(rules)
    found = staged(candidates(staged(postings(docs, rules), "postings"), rules), "candidates")
    found = found.withColumnRenamed("doc_id", "s_doc").withColumnRenamed("s_key", "s_row")
    df = _row_key(docs.select(whole_row(docs).alias("s_whole"), "doc_id", "text")).join(
        found, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("s_key") == F.col("s_row")), "left")
    none = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    parts = []
    for at, rule in enumerate(rules):
        if rule.kind not in full:
            test = F.array_contains("s_kinds", F.lit(rule.kind))
        else:
            test = F.col("s_text").rlike(rule.direct or rule.pattern)
        parts.append(F.when(F.coalesce(test, F.lit(False)), _spans(rule, at, F.col("s_text"))).otherwise(none))
    return (df.withColumn("s_spans", F.array_sort(F.concat(*parts)))
            .drop("s_doc", "s_row", "s_key", "s_kinds"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and spans of each document (the contract's columns)."""
    base = [r.kind for r in rules[:len(BASE)]]
    count = lambda k: F.size(F.filter("s_spans", lambda s: s["kind"] == k)).cast("long")
    own = F.filter("s_spans", lambda s: s["number"] < len(BASE))
    return with_spans(docs.select("doc_id", "text"), rules).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(_listed(own), 256).alias("base_sha256"), _listed(F.col("s_spans")).alias("spans"))


def masked(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``mask`` (overlapping spans by one), and
    ``n_chars`` (if there) counted anew.  Other columns stay as they are."""
    text = F.col("s_text")

    def ends(blocks: Column) -> Column:
        # where each block of spans begins (after all spans before it), and the end of the last
        return F.aggregate(
            blocks, F.array(F.lit(0)),
            lambda acc, block: F.concat(acc, F.array(F.greatest(
                F.element_at(acc, -1), F.array_max(F.transform(block, lambda s: s["end"]))))))

    def walk(block: Column, begin: Column, part: Column) -> Column:
        return F.aggregate(
            block, F.struct(begin.alias("pos"), F.lit("").alias("out")),
            lambda acc, s: F.struct(
                F.greatest(acc["pos"], s["end"]).alias("pos"),
                F.when(s["start"] >= acc["pos"], F.concat(
                    acc["out"], F.substring(part, acc["pos"] - begin + 1, s["start"] - acc["pos"]), F.lit(mask)))
                .otherwise(acc["out"]).alias("out")),
            lambda acc: acc["out"])

    def joined(blocks: Column, begins: Column) -> Column:
        cut = F.transform(blocks, lambda block, i: _named(begins[i], lambda begin: _named(
            F.substring(text, begin + 1, begins[i + 1] - begin), lambda part: walk(block, begin, part))))
        return F.concat(F.array_join(cut, ""), F.substring(text, F.element_at(begins, -1) + 1, F.length(text)))

    walked = _named(_blocks(F.col("s_spans"), lambda block: block),
                    lambda blocks: _named(ends(blocks), lambda begins: joined(blocks, begins)))
    hit = F.size("s_spans") > 0
    new = F.col("s_masked")
    row = F.col("s_whole").withField("text", F.when(hit, new).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(hit, F.length(new).cast(kind)).otherwise(F.col("s_whole.n_chars")))
    return (with_spans(docs, rules).withColumn("s_masked", F.when(hit, walked))
            .select(row.alias("s_whole")).select("s_whole.*"))
