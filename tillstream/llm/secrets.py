"""Secret scans over a trigram index.

Each rule's regular expression is turned into a Boolean trigram query: an OR of ANDs of the trigrams
that any match must contain. The index is a postings table (trigram, document) over the trigrams that
the rules ask for, on lower-cased texts. Postings are intersected by one aggregate per document
and conjunction, and only documents that satisfy a rule's query are verified with its expression. A
rule with an alternative that has no mandatory trigram scans every text.

All of it is DataFrame functions. Matches are the leftmost non-overlapping ones of each rule; a match
whose measured group is too short is dropped after matching, so what it consumed stays consumed.

Defined results: null or empty texts have no spans; repeated rows each get their spans; an empty
table gives no rows; other columns are kept, and columns that begin with an underscore followed by
`secret` are the operator's own. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Alternatives of one rule's query; beyond them a part of the expression counts as a gap.
MOST_ALTERNATIVES = 64
# Length of the runs in which match lengths are summed up.
_RUN = 128
_SPANS = "array<struct<start:int,end:int,measured:int>>"


@dataclass(frozen=True)
class Rule:
    """`group` of a match must have `least` characters or more. `cheap`, if given, is an expression
    that every kept match contains, used to skip texts before positions are worked out."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    cheap: str | None = None


# The base rules.
BASE_RULES = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24, cheap="[0-9a-f]{24}"),
)

# A sequence is a tuple of literal runs; None between them is a gap of unknown text.
_Sequence = tuple


def _joined(left: list[_Sequence], right: list[_Sequence]) -> list[_Sequence]:
    out = []
    for a in left:
        for b in right:
            if a and b and a[-1] is not None and b[0] is not None:
                out.append((*a[:-1], a[-1] + b[0], *b[1:]))
            else:
                out.append(a + b)
    return out if len(out) <= MOST_ALTERNATIVES else [(None,)]


def _sequences(node) -> list[_Sequence]:
    """What a parsed expression can match, as alternatives of literal runs and gaps."""
    out: list[_Sequence] = [()]
    for kind, value in node:
        if kind is sre.LITERAL:
            part = [(chr(value).lower(),)]
        elif kind is sre.SUBPATTERN:
            part = _sequences(value[3])
        elif kind is sre.BRANCH:
            part = [s for branch in value[1] for s in _sequences(branch)]
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and tuple(value[:2]) == (0, 1):
            part = [(), *_sequences(value[2])]
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
            part = _joined(_sequences(value[2]), [(None,)])
        else:
            part = [(None,)]
        out = _joined(out, part)
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The OR of ANDs of trigrams that a match must contain; None if any text may match."""
    query = set()
    for sequence in _sequences(sre_parser.parse(pattern)):
        runs = [run for run in sequence if run is not None]
        grams = frozenset(run[k : k + 3] for run in runs for k in range(len(run) - 2))
        if not grams:
            return None
        query.add(grams)
    return sorted(query, key=sorted)


def postings(docs: DataFrame, grams: list[str], keys: list[str], text: str) -> DataFrame:
    """Rows (keys, gram): which of `grams` (by number) a lower-cased text contains."""
    lower = docs.select(*keys, F.lower(text).alias("_secret_lower"))
    found = [
        F.when(F.contains("_secret_lower", F.lit(gram)), F.lit(k)) for k, gram in enumerate(grams)
    ]
    return lower.select(*keys, F.explode(F.array_compact(F.array(*found))).alias("gram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], keys: list[str], text: str) -> DataFrame:
    """Rows (keys, rules): numbers of the indexed rules whose trigram query a document satisfies."""
    spark = docs.sparkSession
    queries = {n: trigram_query(rule.pattern) for n, rule in enumerate(rules)}
    queries = {n: q for n, q in queries.items() if q is not None}
    grams = sorted({g for q in queries.values() for conj in q for g in conj})
    rows = []
    for n, query in queries.items():
        for c, conj in enumerate(query):
            members = sorted(conj)[:62]  # any part of a conjunction is mandatory too
            rows += [(grams.index(g), n, c, 1 << k, (1 << len(members)) - 1)
                     for k, g in enumerate(members)]
    # As many rows as the rules have trigrams.
    wanted = F.broadcast(
        spark.createDataFrame(rows, "gram int, rule int, conjunction int, bit long, full long")
    )
    hits = postings(docs, grams, keys, text).join(wanted, "gram")
    met = (
        hits.groupBy(*keys, "rule", "conjunction", "full")
        .agg(F.bit_or("bit").alias("seen"))
        .filter(F.col("seen") == F.col("full"))
    )
    return met.groupBy(*keys).agg(F.collect_set("rule").alias("_secret_rules"))


def _let(value: Column, body) -> Column:
    """`body` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)


def _spans(rule: Rule, text: str) -> Column:
    """A rule's spans: array of (start, end, measured) over the column `text`.

    The expression is matched together with the text before it, each time from where the last match
    ended, so lengths alone give positions. They are summed up in runs, so that many matches in one
    text don't take quadratic time.
    """
    pattern = rf"\G(?s:(.*?))({rule.pattern})"

    def lengths(group: int) -> Column:
        found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
        return F.transform(found, lambda m: F.length(m))

    def placed(q: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(q.w) - 1) / _RUN).cast("int"))

        def part(r: Column) -> Column:
            return F.slice(q.w, r * _RUN + 1, _RUN)

        def span(r: Column, k: Column, before: Column) -> Column:
            at = r * _RUN + k - 1
            begin = before + _total(F.slice(part(r), 1, k - 1))
            return F.struct(
                (begin + q.g[at]).alias("start"),
                (begin + q.w[at]).alias("end"),
                q.m[at].alias("measured"),
            )

        def run(r: Column, sums: Column) -> Column:
            places = F.sequence(F.lit(1), F.size(part(r)))
            return _let(
                _total(F.slice(sums, 1, r)),
                lambda before: F.transform(places, lambda k: span(r, k, before)),
            )

        sums = F.transform(runs, lambda r: _total(part(r)))
        spans = _let(sums, lambda sums: F.flatten(F.transform(runs, lambda r: run(r, sums))))
        return F.when(F.size(q.w) > 0, spans).otherwise(F.array().cast(_SPANS))

    read = F.struct(
        lengths(0).alias("w"), lengths(1).alias("g"), lengths(2 + rule.group).alias("m")
    )
    return _let(read, placed)


def _rule_spans(number: int, rule: Rule, text: str) -> Column:
    found = F.filter(_spans(rule, text), lambda s: s.measured >= rule.least)
    return F.transform(
        found,
        lambda s: F.struct(
            s.start.cast("long").alias("start"),
            F.lit(number).alias("rule"),
            F.lit(rule.kind).alias("kind"),
            s.end.cast("long").alias("end"),
        ),
    )


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES, text: str = "text"
) -> DataFrame:
    """`docs` with `secrets`: array of (start, rule, kind, end), by start, then rule."""
    keyed = docs.withColumns(
        {
            "_secret_text": F.coalesce(F.col(text), F.lit("")),
            "_secret_id": F.xxhash64("doc_id", text),
        }
    )
    held = candidates(
        keyed.select("doc_id", "_secret_id", "_secret_text"),
        rules,
        ["doc_id", "_secret_id"],
        "_secret_text",
    ).withColumnsRenamed({"doc_id": "_secret_doc", "_secret_id": "_secret_key"})
    same = F.col("doc_id").eqNullSafe(F.col("_secret_doc")) & (
        F.col("_secret_id") == F.col("_secret_key")
    )
    joined = keyed.join(held, same, "left")
    empty = F.expr("array()").cast("array<struct<start:bigint,rule:int,kind:string,end:bigint>>")
    parts = []
    for number, rule in enumerate(rules):
        scan = rule.cheap is None or F.col("_secret_text").rlike(rule.cheap)
        if trigram_query(rule.pattern) is not None:
            scan = F.coalesce(F.array_contains("_secret_rules", number), F.lit(False))
        if scan is True:
            scan = F.lit(True)
        parts.append(F.when(scan, _rule_spans(number, rule, "_secret_text")).otherwise(empty))
    found = joined.withColumn("secrets", F.array_sort(F.concat(*parts)))
    return found.drop("_secret_text", "_secret_id", "_secret_doc", "_secret_key", "_secret_rules")


def span_list(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    told = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end))
    return F.array_join(told, ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """`text` with every span replaced by `mask`; overlapping spans share one."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s.start >= acc.at
        gap = F.substring(text, (acc.at + 1).cast("int"), (s.start - acc.at).cast("int"))
        out = F.when(fresh, F.concat(acc.out, gap, F.lit(mask))).otherwise(acc.out)
        return F.struct(F.greatest(acc.at, s.end).alias("at"), out.alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc.out, F.substring(text, (acc.at + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, finish))
