"""Column expressions for the coded fields of a game.

Every function takes and returns a ``Column``, so the plans stay inside
Catalyst: nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATING_MIN, RATING_MAX = 400, 3500


def normalise_result(result: Column) -> Column:
    return (
        F.when(result == "1-0", "white_win")
        .when(result == "0-1", "black_win")
        .when(result == "1/2-1/2", "draw")
    )


def normalise_termination(termination: Column) -> Column:
    return F.replace(F.lower(F.trim(termination)), F.lit(" "), F.lit("_"))


def result_reason(termination: Column) -> Column:
    """Why the game ended; unknown terminations pass through in normal form."""
    code = normalise_termination(termination)
    return (
        F.when(code == "normal", "checkmate_or_resignation")
        .when(code == "time_forfeit", "timeout")
        .otherwise(code)
    )


def parse_rating(text: Column) -> Column:
    value = F.trim(text).try_cast("int")
    return F.when(value.between(RATING_MIN, RATING_MAX), value)


def parse_time_control(text: Column) -> Column:
    """``base+increment`` to struct(base_seconds, increment_seconds, estimated_total, time_control_type)."""
    pattern = r"^(\d+)\+(\d+)$"
    base = F.regexp_extract(text, pattern, 1).try_cast("int")
    increment = F.regexp_extract(text, pattern, 2).try_cast("int")
    total = (base.cast("bigint") + F.lit(40) * increment.cast("bigint")).try_cast("int")
    kind = (
        F.when(F.lower(text) == "correspondence", "correspondence")
        .when(total <= 179, "bullet")
        .when(total <= 479, "blitz")
        .when(total <= 1499, "rapid")
        .when(total.isNotNull(), "classical")
    )
    return F.struct(
        base.alias("base_seconds"),
        increment.alias("increment_seconds"),
        total.alias("estimated_total"),
        kind.alias("time_control_type"),
    )


def _clock_seconds(parts: Column) -> Column:
    def whole(index: int) -> Column:
        return F.get(parts, index).try_cast("int").cast("bigint")

    def truncated(index: int) -> Column:
        return F.get(parts, index).try_cast("double").try_cast("int").cast("bigint")

    return (
        F.when(F.size(parts) == 3, whole(0) * 3600 + whole(1) * 60 + truncated(2))
        .when(F.size(parts) == 2, whole(0) * 60 + truncated(1))
        .when(F.size(parts) == 1, truncated(0))
        .try_cast("int")
    )


def parse_clock(text: Column) -> Column:
    """One clock reading (``H:M:S``, ``M:S`` or ``S``) to whole seconds; other shapes give null."""
    return _clock_seconds(F.split(F.trim(text), ":"))


def parse_clocks(text: Column) -> Column:
    """Blank-separated clock readings to ``array<int>``; unreadable tokens are dropped."""
    # two transforms, so that every reading is split only once
    parts = F.transform(F.split(F.trim(text), r"\s+"), lambda reading: F.split(reading, ":"))
    return F.coalesce(F.array_compact(F.transform(parts, _clock_seconds)), F.array().cast("array<int>"))


def dropped_clock_tokens(text: Column) -> Column:
    """How many clock tokens were unreadable (each one shifts the later positions)."""
    tokens = F.array_remove(F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+"), "")
    return F.size(tokens) - F.size(parse_clocks(text))


def parse_game_date(text: Column) -> Column:
    """``yyyy.MM.dd``; dates with unknown parts (``????.??.??``) become null."""
    return F.try_to_timestamp(text, F.lit("yyyy.MM.dd")).cast("date")


def rating_label(rating: Column, size: int = 200) -> Column:
    """``low-high`` label of one rating; labels whose upper end reaches 2200 merge into ``2200+``."""
    low = (F.floor(rating / size) * size).cast("int")
    label = F.concat_ws("-", low.cast("string"), (low + size).cast("string"))
    return F.when(low + size >= 2200, "2200+").when(rating.isNotNull(), label)


def rating_bucket(white: Column, black: Column, size: int = 200) -> Column:
    """Label of the pair's floor average; one known rating stands alone, none gives null."""
    average = F.when(white.isNotNull() & black.isNotNull(), F.floor((white + black) / 2))
    return rating_label(F.coalesce(average, white.cast("bigint"), black.cast("bigint")), size)


def numeric_rating_bucket(white: Column, black: Column) -> Column:
    """Lower end of the 200-wide bucket; needs both ratings."""
    return F.floor((white + black) / 2 / 200) * 200.0


def is_bot(name: Column) -> Column:
    return F.coalesce(F.endswith(F.lower(name), F.lit("bot")), F.lit(False))


def has_bot(white: Column, black: Column) -> Column:
    return is_bot(white) | is_bot(black)


def opening_family(opening: Column) -> Column:
    return F.substring_index(opening, ":", 1)


def opening_variation(opening: Column) -> Column:
    """Trimmed text after the first colon; a name without one is its own variation."""
    tail = F.substring(opening, F.instr(opening, ":") + F.lit(1), F.length(opening))
    return F.when(F.contains(opening, F.lit(":")), F.trim(tail)).otherwise(opening)


def time_left_bucket(seconds: Column) -> Column:
    return (
        F.when(seconds <= 5, "0-5s")
        .when(seconds <= 15, "6-15s")
        .when(seconds <= 30, "16-30s")
        .when(seconds <= 60, "31-60s")
        .when(seconds.isNotNull(), "60s+")
    )


def phase_of_ply(ply: Column) -> Column:
    return F.when(ply <= 20, "opening").when(ply <= 60, "middlegame").otherwise("endgame")


def phase_of_move(move_number: Column, piece_count: Column) -> Column:
    """Phase by move number, with 20 pieces or fewer always an endgame."""
    return (
        F.when(move_number.isNull(), F.lit(None).cast("string"))
        .when(piece_count <= 20, "endgame")
        .when(move_number <= 10, "opening")
        .when(move_number <= 30, "middlegame")
        .otherwise("endgame")
    )


def winner(result: Column, white: Column, black: Column) -> Column:
    return F.when(result == "white_win", white).when(result == "black_win", black)


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts joined by ``|``, nulls as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(part.cast("string"), F.lit("")) for part in parts]))


def period(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def previous_period(text: Column) -> Column:
    """``yyyy-MM`` of the month before."""
    first = F.try_to_timestamp(text, F.lit("yyyy-MM")).cast("date")
    return F.date_format(F.add_months(first, -1), "yyyy-MM")


def display_rank(value: Column, ordered: list[str]) -> Column:
    """1-based position of ``value`` in a fixed display order, null when unknown."""
    rank = F.array_position(F.array(*[F.lit(item) for item in ordered]), value)
    return F.when(rank > 0, rank.cast("int"))


def stable_round(value: Column, digits: int) -> Column:
    """Round twice so that the last bits of a distributed sum cannot flip a tie."""
    return F.round(F.round(value, digits + 6), digits)
