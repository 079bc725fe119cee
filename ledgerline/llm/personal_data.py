"""Personal data in text: fixed patterns, and contexts learned from what they find.

The fixed patterns give seed entities. The words around them become lexical patterns
(the word before; two words before; the words before and after), and patterns and
instances form a bipartite graph. Instances are the fixed patterns' spans and the
candidates: tokens with a digit or an @, neighbouring groups of digits as one. Spark
scores the graph in rounds: a pattern is as reliable as the share of its distinct
instances that are known entities, an instance is as likely as the patterns it
occurs with make it. Candidates that reliable patterns introduce are added as further
spans of the pattern's kind.

Everything is SQL functions. Offsets are code points, end exclusive. They come from
splitting a text at a pattern and adding up the lengths of pieces and matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.workspace import freeze

KINDS = ("email", "ip", "card", "phone")

# The greedy forms are fixed by the task; possessive repeats and the test that a match
# begins where a run begins (or where the last match ended) keep them linear.
_BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_SPACE = r"\x20\t\n\r\f\x0b"
_AFTER_DIGITS = rf"(?![^{_SPACE},;:!?)\]}}\"'])"
# Groups of digits with one blank between them, or a token with a digit or an @.
_CANDIDATE = (
    rf"(?<![^{_SPACE}])(?:"
    rf"(?:[A-Za-z_]++[=:][\"']?+)?+[(+]?+[0-9][0-9()./-]*+{_AFTER_DIGITS}(?:\x20[(]?+[0-9][0-9()./-]*+{_AFTER_DIGITS})++"
    rf"|[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+)"
)
_NAME = r"^([A-Za-z_]++[=:][\"']?)(.+)$"  # name=value and name:value are a word and a value
_NO_PATTERNS = "array<struct<start: bigint, end: bigint, value: string, before: string, after: string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running_sum(numbers: Column) -> Column:
    """Sums of all leading parts of an array, in rounds that double the reach of each sum."""

    def doubled(sums: Column, reach: Column) -> Column:
        moved = F.concat(F.array_repeat(F.lit(0).cast("bigint"), reach), F.slice(sums, F.lit(1), F.size(sums) - reach))
        return F.zip_with(sums, moved, lambda a, b: a + b)

    def summed(first: Column) -> Column:
        rounds = F.ceil(F.log2(F.size(first).cast("double"))).cast("int")
        reaches = F.transform(F.sequence(F.lit(0), rounds - 1), lambda k: F.call_function("shiftleft", F.lit(1), k))
        return F.when(F.size(first) < 2, first).otherwise(F.aggregate(reaches, first, doubled))

    return _let(numbers, summed)


def _found(text: Column, pattern: str) -> Column:
    """Matches of a pattern: array of (start, end, value, piece before, piece after)."""

    def spans(x: Column) -> Column:
        pieces, values, ends = x["pieces"], x["values"], x["ends"]
        return F.transform(
            values,
            lambda value, i: F.struct(
                (F.get(ends, i) - F.char_length(value)).alias("start"),
                F.get(ends, i).alias("end"),
                value.alias("value"),
                F.get(pieces, i).alias("before"),
                F.get(pieces, i + 1).alias("after"),
            ),
        )

    def ended(x: Column) -> Column:
        lengths = F.transform(x["values"], lambda v, i: (F.char_length(F.get(x["pieces"], i)) + F.char_length(v)).cast("bigint"))
        return _let(
            F.struct(x["pieces"].alias("pieces"), x["values"].alias("values"), _running_sum(lengths).alias("ends")), spans
        )

    halves = F.struct(
        F.split(text, pattern, -1).alias("pieces"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values")
    )
    return _let(halves, ended)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(parts, lambda p: F.coalesce(p.try_cast("bigint"), F.lit(256)) <= 255)
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _matches(text: Column, kind: str) -> Column:
    """All matches of a kind, valid or not; texts that cannot hold one are not searched."""
    possible = text.contains(_NEEDS[kind]) if _NEEDS[kind] else text.rlike("[0-9]")
    return F.when(possible, _found(text, _BASE[kind])).otherwise(F.array().cast(_NO_PATTERNS))


def _context(span: Column, name: Column) -> list[Column]:
    """The two words before a match and the one after it, in lower case; missing words are empty.

    A name that is part of the match counts as the word before.
    """
    word = rf"[^{_SPACE}]"
    last = F.regexp_extract(span["before"], rf"(?<!{word})({word}++)[{_SPACE}]*+$", 1)
    second = F.regexp_extract(span["before"], rf"(?<!{word})({word}++)[{_SPACE}]++{word}++[{_SPACE}]*+$", 1)
    right = F.regexp_extract(span["after"], rf"^[.,;:!?)\]}}\"']*+[{_SPACE}]++({word}++)", 1)
    named = name != ""
    return [
        F.lower(F.when(named, name).otherwise(last)).alias("left"),
        F.lower(F.when(named, last).otherwise(second)).alias("left2"),
        F.lower(right).alias("right"),
    ]


def _spans_of(source: DataFrame) -> DataFrame:
    """Per document, without its text: ``base``, ``rejected`` and ``candidates``.

    The first two are the matches of the fixed patterns that pass or fail their checks,
    as (start, kind number, end, value and words around), the last are the candidates.
    """
    matched = source.select("*", *[_matches(F.col("_text"), kind).alias(f"_{kind}") for kind in KINDS])

    def of_kind(number: int, kind: str, valid: bool) -> Column:
        return F.transform(
            F.filter(f"_{kind}", lambda m: _valid(kind, m["value"]) == F.lit(valid)),
            lambda m: F.struct(
                m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"),
                *([m["value"].alias("value"), *_context(m, F.lit(""))] if valid else []),
            ),
        )

    def gathered(valid: bool) -> Column:
        return F.sort_array(F.concat(*[of_kind(n, kind, valid) for n, kind in enumerate(KINDS)]))

    def candidate(m: Column) -> Column:
        def bare(name: Column) -> Column:
            value = F.regexp_replace(F.substr(m["value"], F.length(name) + 1), r"[.,;:!?)\]}\"']+$", "")
            return F.struct(
                (m["start"] + F.length(name)).alias("start"),
                (m["start"] + F.length(name) + F.char_length(value)).alias("end"),
                value.alias("value"),
                *_context(m, name),
            )

        return _let(F.regexp_extract(m["value"], _NAME, 1), bare)

    holds = F.col("_text").rlike("[0-9@]")
    found = F.when(holds, _found(F.col("_text"), _CANDIDATE)).otherwise(F.array().cast(_NO_PATTERNS))
    candidates = F.filter(F.transform(found, candidate), lambda c: F.length(c["value"]) > 0)
    return matched.select(
        "_doc", "_key", gathered(True).alias("base"), gathered(False).alias("rejected"), candidates.alias("candidates")
    )


def _instances(spans: DataFrame) -> DataFrame:
    """One row per base span and per candidate that overlaps none, with the words around.

    ``kind`` is a base span's; ``refused`` lists the kinds whose pattern matched part
    of a candidate and failed its check. A document's spans are put in order by start
    and by end: a span overlaps a candidate if it starts before the candidate ends and
    is not over where the candidate starts, so two running values decide.
    """
    at = ["_doc", "_key"]
    words = ["value", "left", "left2", "right"]
    spans = spans.where("_doc IS NOT NULL")

    def rows(column: str, role: Column, kind: Column, held: bool) -> DataFrame:
        one = spans.select(*at, F.explode(column).alias("s"))
        texts = [F.col(f"s.{w}").alias(w) if held else F.lit(None).cast("string").alias(w) for w in words]
        return one.select(*at, role.alias("role"), kind.cast("int").alias("kind"), "s.start", "s.end", *texts)

    base = rows("base", F.lit(0), F.col("s.kind"), True)
    marks = base.unionByName(rows("rejected", F.lit(1), F.col("s.kind"), False)).unionByName(
        rows("candidates", F.lit(2), F.lit(None), True)
    )
    upward = Window.partitionBy(*at).orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    downward = Window.partitionBy(*at).orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow)

    def overlapped(role: int, kind: int | None) -> Column:
        """Whether a span of this role (and kind) shares a place with the row's."""
        of = (F.col("role") == role) if kind is None else (F.col("role") == role) & (F.col("kind") == kind)
        earlier = F.max(F.when(of, F.col("end"))).over(upward)
        later = F.min(F.when(of, F.col("start"))).over(downward)
        return F.coalesce(earlier > F.col("start"), F.lit(False)) | F.coalesce(later < F.col("end"), F.lit(False))

    decided = marks.select(
        "*", overlapped(0, None).alias("inside"), *[overlapped(1, n).alias(f"failed{n}") for n in range(len(KINDS))]
    )
    refused = F.filter(
        F.array(*[F.when(F.col(f"failed{n}"), F.lit(n)) for n in range(len(KINDS))]), lambda n: n.isNotNull()
    )
    return decided.where("role = 0 OR (role = 2 AND NOT inside)").select(
        *at, "start", "end", "kind", "value", _patterns().alias("patterns"), refused.alias("refused")
    )


def _patterns() -> Column:
    """Patterns an instance occurs in: none without a word before it."""
    left, left2, right = F.col("left"), F.col("left2"), F.col("right")
    wider = [
        F.when(left2 != "", F.concat_ws(" ", left2, left, F.lit("*"))),
        F.when(right != "", F.concat_ws(" ", left, F.lit("*"), right)),
    ]
    every = F.array(F.when(left != "", F.concat_ws(" ", left, F.lit("*"))), *[F.when(left != "", w) for w in wider])
    return F.filter(every, lambda p: p.isNotNull())


def _plausible(value: Column, kind: Column) -> Column:
    """What a candidate needs in order to be of a kind at all."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    return (
        F.when(kind == KINDS.index("email"), value.rlike("^[^@]++@[^@]++$"))
        .when(kind == KINDS.index("ip"), value.rlike(r"[0-9a-fA-F]+([.:])[0-9a-fA-F]*\1"))
        .when(kind == KINDS.index("card"), digits.between(12, 19))
        .otherwise(digits.between(7, 15) & ~value.contains("@"))
    )


def _bootstrapped(instances: DataFrame, rounds: int, support: int, confidence: float) -> DataFrame:
    """(pattern, found_kind, confidence) of reliable patterns."""
    occurrences = instances.select(F.explode("patterns").alias("pattern"), "value", "kind")
    edges = freeze(occurrences.select("pattern", "value").distinct(), "pattern-graph")
    seeds = freeze(
        instances.where("kind IS NOT NULL").select("value", "kind").distinct().withColumn("seed_score", F.lit(1.0)), "seeds"
    )
    known = seeds.select("value", "kind", F.col("seed_score").alias("score"))
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("instances"))
    patterns = None
    for _ in range(rounds):
        hits = edges.join(known, "value").groupBy("pattern", "kind").agg(
            F.sum("score").alias("hits"), F.count_if(F.col("score") >= confidence).alias("support")
        )
        # One more instance than seen, so that a few hits are no proof.
        patterns = freeze(
            hits.where(F.col("support") >= support).join(sizes, "pattern")
            .select("pattern", "kind", (F.col("hits") / (F.col("instances") + 1)).alias("confidence")),
            "pattern-scores",
        )
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))
        implied = edges.join(patterns, "pattern").groupBy("value", "kind").agg((1 - doubt).alias("score"))
        known = freeze(
            implied.join(seeds, ["value", "kind"], "full").select(
                "value", "kind", F.greatest(F.coalesce("score", F.lit(0.0)), F.coalesce("seed_score", F.lit(0.0))).alias("score")
            ),
            "instance-scores",
        )
    return patterns.where(F.col("confidence") >= confidence).withColumnRenamed("kind", "found_kind")


def find_personal_data(
    docs: DataFrame,
    *,
    rounds: int = 2,
    support: int = 3,
    confidence: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, base, spans``.

    Both are arrays of (start, kind, end), ordered by start, then kind. ``base`` has
    the matches of the fixed patterns that pass their checks; ``spans`` adds the
    candidates that learned patterns introduce. A pattern needs ``support`` distinct
    seeds and the given ``confidence``. A candidate that overlaps a base span is never
    added, nor one that failed the check of a kind as that kind, and it needs what the
    kind needs at least, such as enough digits. Where patterns disagree the more
    confident one decides, then the kind listed first. A run of digit groups with
    single blanks is one candidate of all its digits.

    A null text counts as empty. Rows that repeat an id are told apart by their
    text; rows that repeat both get the same spans, and null ids get base spans only.
    An empty table gives an empty result. Other columns are not looked at. Work grows
    with a text's length, times the logarithm of its number of matches.
    """
    if rounds < 1:
        raise ValueError("at least one round")
    texts = F.coalesce(F.col(text_column), F.lit(""))
    source = docs.select(F.col(id_column).cast("bigint").alias("_doc"), F.xxhash64(texts).alias("_key"), texts.alias("_text"))
    spans = freeze(_spans_of(source), "spans")
    instances = freeze(_instances(spans), "instances")
    patterns = freeze(_bootstrapped(instances, rounds, support, confidence), "patterns")
    place = ["_doc", "_key", "start", "end"]
    introduced = (
        instances.where("kind IS NULL").select(*place, "value", "refused", F.explode("patterns").alias("pattern"))
        .join(patterns, "pattern")
        .where(~F.array_contains("refused", F.col("found_kind")) & _plausible(F.col("value"), F.col("found_kind")))
        .groupBy(*place)
        .agg(F.max(F.struct("confidence", (-F.col("found_kind")).alias("order"))).alias("best"))
    )
    added = introduced.groupBy("_doc", "_key").agg(
        F.collect_list(F.struct("start", (-F.col("best.order")).cast("int").alias("kind"), "end")).alias("_added")
    )
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return spans.select("_doc", "_key", base.alias("base")).join(added, ["_doc", "_key"], "left").select(
        F.col("_doc").alias("doc_id"),
        "base",
        F.when(F.col("_added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "_added"))).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
