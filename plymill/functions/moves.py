"""Move text to move arrays and move features, as regular expressions over whole strings.

Cleaning works on the text of a game rather than on its tokens: a handful of
linear passes inside generated code, and only one split at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Standard algebraic notation, and the codes that end a game.
SAN = (
    r"(?:O-O(?:-O)?"
    r"|[KQRBN][a-h]?[1-8]?x?[a-h][1-8]"
    r"|(?:[a-h][1-8]?x)?[a-h][1-8](?:=?[QRBN])?)"
    r"[+#]?"
)
END_CODES = r"(?:1-0|0-1|1/2-1/2|\*)"


def strip_comments(text: Column) -> Column:
    """Drop ``{...}`` comments and ``;`` comments up to the end of the line."""
    return F.regexp_replace(F.regexp_replace(text, r"\{[^}]*\}", " "), r";[^\n\r]*", " ")


def strip_variations(text: Column) -> Column:
    """Remove bracketed side lines, innermost first, until none is left.

    Each pass removes one nesting level, so the number of opening brackets
    bounds the passes; texts without brackets skip the loop.
    """
    peeled = F.aggregate(
        F.sequence(F.lit(1), F.regexp_count(text, F.lit(r"\("))),
        text,
        lambda current, _: F.when(
            F.contains(current, F.lit(")")), F.regexp_replace(current, r"\([^()]*\)", " ")
        ).otherwise(current),
    )
    return F.when(F.contains(text, F.lit("(")), peeled).otherwise(text)


def strip_numbers(text: Column) -> Column:
    """Drop numeric glyphs and move numbers, then squeeze the blanks.

    Other white space turns into plain blanks first, which keeps the squeezing
    pattern a literal one.
    """
    blanks = F.translate(text, "\t\n\r\f\v\u00a0", " " * 6)
    plain = F.regexp_replace(blanks, r"\$\d+|\d+\.(?:\.\.)?", " ")
    return F.trim(F.regexp_replace(plain, "  +", " "))


def strip_noise(text: Column) -> Column:
    """Drop comments, side lines, numeric glyphs and move numbers; single blanks remain."""
    return strip_numbers(strip_variations(strip_comments(text)))


def clean_tokens(text: Column) -> Column:
    """Strip leading dots and ``!``/``?`` marks from every blank-separated token."""
    cleaned = F.regexp_replace(text, r"[!?]+(?= |$)", "")
    return F.regexp_replace(cleaned, r"(?<![^ ])(?:\.+[!?]*|[!?]+)", "")


def drop_end_codes(text: Column) -> Column:
    """Drop result codes and the gaps they and emptied tokens leave; the text has only plain blanks."""
    bare = F.regexp_replace(text, rf"(?:^| ){END_CODES}(?= |$)", "")
    return F.trim(F.regexp_replace(bare, "  +", " "))


def move_text(text: Column) -> Column:
    """Blank-separated bare moves of a game; null stays null."""
    return drop_end_codes(clean_tokens(strip_noise(text)))


def _first_bad(bare: Column) -> Column:
    return F.regexp_instr(bare, F.lit(rf"(?<![^ ])(?!{SAN}(?: |$))[^ ]"))


def _cut(bare: Column, first_bad: Column) -> Column:
    return F.when(first_bad > 0, F.rtrim(F.substring(bare, F.lit(1), first_bad - 1))).otherwise(bare)


def valid_prefix(bare: Column) -> Column:
    """Leading part of a bare move text up to, not including, the first malformed token."""
    return _cut(bare, _first_bad(bare))


def to_tokens(bare: Column) -> Column:
    """Split a bare move text; null and blank text give the empty array."""
    return F.when(F.length(bare) > 0, F.split(bare, " ")).otherwise(F.array().cast("array<string>"))


def parse_tokens(text: Column) -> Column:
    return to_tokens(move_text(text))


def parse_moves(text: Column) -> Column:
    return to_tokens(valid_prefix(move_text(text)))


def with_moves(df: DataFrame, source: str = "moves") -> DataFrame:
    """Adds ``moves_san`` and ``features``, the parsed moves of a text column and their features.

    The same steps as :func:`parse_moves`, as named columns: each one is used
    more than once by the next, and the optimizer keeps such columns apart
    instead of repeating the work.
    """
    prefix = F.col("_prefix")
    return (
        df.withColumn("_plain", strip_comments(F.col(source)))
        .withColumn("_main", strip_variations(F.col("_plain")))
        .withColumn("_bare", drop_end_codes(clean_tokens(strip_numbers(F.col("_main")))))
        .withColumn("_bad", _first_bad(F.col("_bare")))
        .withColumn("_prefix", _cut(F.col("_bare"), F.col("_bad")))
        .withColumn("moves_san", to_tokens(prefix))
        .withColumn("features", _features(F.col("moves_san"), F.coalesce(prefix, F.lit(""))))
        .drop("_plain", "_main", "_bare", "_bad", "_prefix")
    )


def capture_count(moves: Column) -> Column:
    """Captures in a move array; a move holds at most one ``x``."""
    return _captures(F.array_join(moves, " "))


def _captures(joined: Column) -> Column:
    return F.length(joined) - F.length(F.replace(joined, F.lit("x"), F.lit("")))


def castled(moves: Column, side: int) -> Column:
    """Whether the side (0 = first mover, 1 = second) castled."""
    return _castled(moves, F.array_join(moves, " "), side)


def _castled(moves: Column, joined: Column, side: int) -> Column:
    own = F.filter(moves, lambda move, index: move.startswith("O-O") & (index % 2 == side))
    return F.when(F.contains(joined, F.lit("O-O")), F.size(own) > 0).otherwise(False)


def _features(moves: Column, joined: Column) -> Column:
    return F.struct(
        (_captures(joined) > 0).alias("has_capture"),
        _captures(joined).alias("capture_count"),
        _castled(moves, joined, 0).alias("white_castled"),
        _castled(moves, joined, 1).alias("black_castled"),
        F.size(moves).alias("legal_prefix_length"),
    )


def move_features(moves: Column) -> Column:
    return _features(moves, F.array_join(moves, " "))
