"""Line de-duplication with a fixed-depth template tree, in SQL functions only.

A line's tokens are its stretches without white space; a token with a digit is a
variable field and reads ``<*>``. The upper levels of the tree are the number of tokens and
the leading tokens. A leaf's template has, at each place, the token that more than half of
the leaf's distinct lines have there, and ``<*>`` elsewhere; a line belongs to it if at least
``similarity`` of its tokens are the template's.

A leaf may hold several families of lines. The lines left over are therefore split by their token at one place: the
place whose tokens fall into the fewest groups of weight, looked for at ``PROBES`` places
spread over the line, so that any stretch of more than an eighth of a line is met. Each line goes to one child, children vote
as leaves do, and this is repeated ``depth`` times or until no child has two lines. So a level
costs one row for each line, and its tokens once. Lines without a template are templates of their own. So are lines of few
tokens, such as those in scripts without spaces, from ``min_characters`` characters on.

Templates that occur in several documents are boilerplate: their lines are dropped, except the first.

Everything that decides works on hashes of lines. Document text is shuffled
twice: to meet the places of distinct lines in leaves that have several, and to meet
the list of lines to drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.workspace import freeze

BLANKS = " \t\r\f\x0b"
_BLANK = r" \t\r\f\x0b"
VARIABLE = "<*>"
DEPTH = 3  # times that the lines left over in a leaf are split
PROBES = 8  # places at which a split is looked for
# Only a token's first character may start a match, and nothing is tried twice.
_WITH_DIGIT = r"(?<![^ \t\r\f\x0b])[^ \t\r\f\x0b0-9]*+[0-9][^ \t\r\f\x0b]*+"


def line_tokens(line: Column) -> Column:
    """Tokens of a line, variable fields as ``<*>``; an empty array for a blank one."""
    trimmed = F.btrim(line, F.lit(BLANKS))
    masked = F.when(trimmed.rlike("[0-9]"), F.regexp_replace(trimmed, _WITH_DIGIT, VARIABLE)).otherwise(trimmed)
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(masked, r"[ \t\r\f\x0b]+"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _leaf(leading: int) -> Column:
    return F.xxhash64(F.size("_tokens"), F.slice("_tokens", 1, leading))


def _picked(text: Column, places: Column, then) -> Column:
    """``then`` of the array of the text's lines at these places. The text is split once, not once a place."""
    both = F.array(F.struct(_lines(text).alias("lines"), places.alias("places")))
    return F.transform(both, lambda b: then(F.transform(b["places"], lambda i: F.get(b["lines"], i))))[0]


def _hashed(docs: DataFrame, leading: int, min_tokens: int, min_characters: int) -> DataFrame:
    """Lines that take part, with their leaf and their own key; ``_short`` ones are no part of the tree."""
    lines = docs.select("_doc", "_text_key", F.posexplode(_lines(F.col("_text"))).alias("_place", "_line"))
    # Tokens are only counted here, and made once, above the filter.
    short = ~F.col("_line").rlike(rf"^[{_BLANK}]*+(?:[^{_BLANK}]++[{_BLANK}]++){{{min_tokens - 1}}}[^{_BLANK}]")
    long_enough = F.char_length(F.btrim("_line", F.lit(BLANKS))) >= min_characters
    tokens = lines.where(~short | long_enough).withColumn("_tokens", line_tokens(F.col("_line")))
    return tokens.select(
        "_doc", "_text_key", "_place", short.alias("_short"), _leaf(leading).alias("_leaf"), F.xxhash64("_tokens").alias("_key")
    )


def _voted(lines: DataFrame) -> DataFrame:
    """(group, template) by strict majority at each place, for lines of (group, tokens)."""
    sizes = lines.groupBy("_group").agg(F.count("*").alias("_lines"))
    votes = (
        lines.select("_group", F.posexplode("_tokens").alias("_i", "_token"))
        .groupBy("_group", "_i", "_token").agg(F.count("*").alias("_n"))
        .groupBy("_group", "_i").agg(F.max(F.struct("_n", "_token")).alias("_top"))
    )
    majority = F.when(F.col("_top._n") * 2 > F.col("_lines"), F.col("_top._token"))
    return (
        votes.join(sizes, "_group")
        .groupBy("_group")
        .agg(F.sort_array(F.collect_list(F.struct("_i", majority.alias("_t")))).alias("_template"))
    )


def _belongs(similarity: float) -> Column:
    """Whether enough of the tokens are the template's."""
    same = F.aggregate(
        F.zip_with("_tokens", "_template", lambda t, c: F.when(t == c["_t"], 1).otherwise(0)),
        F.lit(0),
        lambda total, x: total + x,
    )
    return same >= F.size("_tokens") * F.lit(similarity)


def _split(rest: DataFrame, leading: int) -> DataFrame:
    """The lines with the child of their group that they go to, where a child has two lines or more.

    The weight of a place is the number of pairs of lines that agree there. Places at which a fifth of the lines' weight
    is lost at least are preferred, of these the heaviest; so two or three families go apart and a variable field is
    no choice as long as there is another.
    """
    free = F.size("_tokens") - leading
    count = F.least(F.lit(PROBES), free)
    probes = F.transform(F.sequence(F.lit(0), count - 1), lambda k: (leading + F.floor(k * free / count)).cast("int"))
    seen = rest.where(free > 0).select("_group", "_tokens", F.explode(F.array_distinct(probes)).alias("_i"))
    weights = (
        seen.groupBy("_group", "_i", F.get("_tokens", F.col("_i")).alias("_token")).agg(F.count("*").alias("_n"))
        .groupBy("_group", "_i").agg(F.sum("_n").alias("_lines"), F.sum(F.col("_n") * F.col("_n")).alias("_weight"))
        .where(F.col("_weight") < F.col("_lines") * F.col("_lines"))
    )
    parts = F.col("_lines") * F.col("_lines") * 4 >= F.col("_weight") * 5
    choice = F.struct(
        F.when(parts, 1).otherwise(0).alias("_parts"),
        F.when(parts, F.col("_weight")).otherwise(-F.col("_weight")).alias("_order"),
        (-F.col("_i")).alias("_minus"),
    )
    chosen = weights.groupBy("_group").agg(F.max(choice).alias("_best")).select("_group", (-F.col("_best._minus")).alias("_at"))
    moved = rest.join(chosen, "_group").withColumn("_group", F.xxhash64("_group", "_at", F.get("_tokens", F.col("_at"))))
    moved = freeze(moved.drop("_at"), "split-lines")
    several = moved.groupBy("_group").agg(F.count("*").alias("_n")).where("_n > 1").select("_group")
    return moved.join(several, "_group", "left_semi")


def _general_lines(docs: DataFrame, hashed: DataFrame, leading: int, similarity: float, depth: int) -> DataFrame:
    """(leaf, key, template number) of the distinct lines that belong to a template of their leaf."""
    firsts = freeze(
        hashed.where("NOT _short").groupBy("_leaf", "_key")
        .agg(F.min(F.struct("_doc", "_text_key", "_place")).alias("_at")),
        "first-places",
    )
    several = freeze(
        firsts.groupBy("_leaf").agg(F.count("*").alias("_n")).where("_n > 1").select("_leaf"), "shared-leaves"
    )
    # One place for each distinct line of a shared leaf; the documents that hold one are read again.
    places = freeze(
        firsts.join(several, "_leaf").groupBy("_at._doc", "_at._text_key").agg(F.collect_list("_at._place").alias("_places")),
        "places",
    )
    held = docs.join(places.hint("merge"), ["_doc", "_text_key"])
    picked = held.select(F.explode(_picked(F.col("_text"), F.col("_places"), lambda found: found)).alias("_line"))
    parsed = picked.select(line_tokens(F.col("_line")).alias("_tokens"))
    parsed = parsed.select(_leaf(leading).alias("_leaf"), F.xxhash64("_tokens").alias("_key"), "_tokens")
    open_ = freeze(
        parsed.groupBy("_leaf", "_key").agg(F.first("_tokens").alias("_tokens")).withColumn("_group", F.col("_leaf")),
        "distinct-lines",
    )
    found: DataFrame | None = None
    for level in range(depth + 1):
        templates = freeze(_voted(open_), "templates")
        judged = freeze(
            open_.join(templates, "_group").select("_leaf", "_key", "_group", "_tokens", _belongs(similarity).alias("_fits")),
            "judged-lines",
        )
        fit = judged.where("_fits").select("_leaf", "_key", F.col("_group").alias("_number"))
        found = fit if found is None else found.unionByName(fit)
        if level < depth:
            open_ = freeze(_split(judged.where("NOT _fits").drop("_fits"), leading), "open-lines")
            if open_.isEmpty():
                break
    return found


def drop_recurring_lines(
    docs: DataFrame,
    *,
    min_documents: int = 2,
    min_tokens: int = 3,
    leading: int = 3,
    similarity: float = 0.8,
    depth: int = DEPTH,
    min_characters: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` without recurring lines, and with ``n_lines`` and ``n_dropped``.

    A line is dropped if its template occurs in at least ``min_documents``
    documents and it is not the template's first line (by id, then place). So
    no passage is lost altogether. Documents with the very same text count as
    one, so a document is not emptied for having a copy; that is for document
    de-duplication. Lines of fewer than ``min_tokens`` tokens recur only as they are (but for
    fields with digits), and always stay below ``min_characters`` characters without their margins.

    A null text stays null, with 0 lines; an empty text has one blank line. Rows with a
    null id are left as they are and count for nothing. Rows that repeat an id and
    text are treated alike; rows that repeat an id with other texts are documents of
    their own. An empty table gives an empty result. Other columns pass through;
    ``n_lines`` and ``n_dropped`` replace columns of those names.
    """
    keyed = docs.select(
        F.col(id_column).alias("_doc"), F.col(text_column).alias("_text"), F.xxhash64(text_column).alias("_text_key")
    ).where("_doc IS NOT NULL AND _text IS NOT NULL")
    hashed = freeze(_hashed(keyed, leading, min_tokens, min_characters), "line-hashes")
    general = _general_lines(keyed, hashed, leading, similarity, depth)
    mapped = freeze(
        hashed.join(general, ["_leaf", "_key"], "left").select(
            "_doc", "_text_key", "_place", "_leaf", F.coalesce("_number", "_key").alias("_template")
        ),
        "line-templates",
    )
    recurring = freeze(
        mapped.groupBy("_leaf", "_template", "_text_key").agg(F.min(F.struct("_doc", "_place")).alias("_first"))
        .groupBy("_leaf", "_template").agg(F.count("*").alias("_documents"), F.min("_first").alias("_first"))
        .where(F.col("_documents") >= min_documents),
        "recurring-templates",
    )
    dropped = (
        mapped.join(recurring, ["_leaf", "_template"])
        .where((F.col("_doc") != F.col("_first._doc")) | (F.col("_place") != F.col("_first._place")))
        .groupBy("_doc", "_text_key")
        .agg(F.collect_set("_place").alias("_places"))
    )
    lines = _lines(F.col(text_column))
    # By a hash set: a document may lose very many lines.
    stay = F.array_except(F.sequence(F.lit(0), F.array_size(lines) - 1), F.col("_places"))
    kept = _picked(F.col(text_column), stay, lambda found: F.array_join(found, "\n"))
    rest = [F.col(f"d.`{c}`") for c in docs.columns if c not in (text_column, "n_lines", "n_dropped")]
    d = docs.withColumn("_line_text_key", F.xxhash64(text_column)).alias("d")
    joined = d.join(
        dropped.hint("merge").alias("x"),
        (F.col(f"d.`{id_column}`") == F.col("x._doc")) & (F.col("d._line_text_key") == F.col("x._text_key")),
        "left",
    )
    out = joined.select(
        *rest,
        F.when(F.col("_places").isNull(), F.col(f"d.`{text_column}`")).otherwise(kept).alias(text_column),
        F.coalesce(F.array_size(lines), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.array_size("_places"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )
    return out.select(*[c for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
