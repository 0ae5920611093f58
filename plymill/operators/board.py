"""Facts about the board read from a game's move array, without replaying it.

Everything is computed inside the row from native array functions: no move is
exploded and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Piece values in centipawns, and the back rank by file a..h.
PIECE_VALUES = {"P": 100, "N": 320, "B": 330, "R": 500, "Q": 900}
BACK_RANK = "RNBQKBNR"
FILES = "abcdefgh"

_PAWN_CAPTURE = r"^[a-h][1-8]?x([a-h][36])"
_PROMOTION = r"[1-8]=?([QRBN])[+#]?$"


def _value(letter: Column) -> Column:
    known = F.create_map(*[F.lit(item) for pair in PIECE_VALUES.items() for item in pair])
    return F.coalesce(F.try_element_at(known, letter), F.lit(0))


def _home_rank(index: Column) -> Column:
    return F.when(index % 2 == 0, "1").otherwise("8")


def target_square(move: Column, index: Column) -> Column:
    """Destination of the moving piece; castling names the king's square."""
    rank = _home_rank(index)
    return (
        F.when(move.startswith("O-O-O"), F.concat(F.lit("c"), rank))
        .when(move.startswith("O-O"), F.concat(F.lit("g"), rank))
        .otherwise(F.regexp_extract(move, r"([a-h][1-8])(?:=?[QRBN])?[+#]?$", 1))
    )


def landed_piece(move: Column) -> Column:
    """Letter of the piece standing on the destination after the move."""
    letter = F.substring(move, 1, 1)
    return (
        F.when(letter == "O", "K")
        .when(letter.isin("K", "Q", "R", "B", "N"), letter)
        .otherwise(F.coalesce(F.nullif(F.regexp_extract(move, _PROMOTION, 1), F.lit("")), F.lit("P")))
    )


def _starting_piece(square: Column) -> Column:
    file, rank = F.substring(square, 1, 1), F.substring(square, 2, 1)
    back = F.substring(F.lit(BACK_RANK), F.instr(F.lit(FILES), file), F.lit(1))
    return F.when(rank.isin("1", "8"), back).when(rank.isin("2", "7"), "P").otherwise("P")


def _rook_square(move: Column, index: Column) -> Column:
    rank = _home_rank(index)
    return (
        F.when(move.startswith("O-O-O"), F.concat(F.lit("d"), rank))
        .when(move.startswith("O-O"), F.concat(F.lit("f"), rank))
        .otherwise("")
    )


def arrivals(moves: Column) -> tuple[Column, Column]:
    """Squares reached and the pieces that reached them, two slots per move.

    The second slot is the rook of a castling move and is blank otherwise.
    """
    squares = F.flatten(F.transform(moves, lambda m, i: F.array(target_square(m, i), _rook_square(m, i))))
    pieces = F.flatten(F.transform(moves, lambda m: F.array(landed_piece(m), F.lit("R"))))
    return squares, pieces


def material_changes(moves: Column, squares: Column, pieces: Column) -> Column:
    """Centipawns every move adds to its own side: the piece taken plus any promotion.

    The piece taken is the last one that arrived on the square, else the one
    that started there.  A pawn that takes diagonally past an enemy pawn pushed
    just before onto the neighbouring rank takes that pawn: such a push always
    leaves the square behind it empty.
    """

    def taken(move: Column, index: Column) -> Column:
        square = F.get(squares, index * 2)
        back = F.array_position(F.reverse(F.slice(squares, F.lit(1), index * 2)), square)
        last = F.get(pieces, (index * 2 - back).cast("int"))
        return _value(F.when(back > 0, last).otherwise(_starting_piece(square)))

    def passing(move: Column, index: Column) -> Column:
        skipped = F.regexp_extract(move, _PAWN_CAPTURE, 1)
        beyond = F.translate(skipped, "36", "45")
        mover_rank = F.when(index % 2 == 0, "6").otherwise("3")
        previous = F.rtrim(F.get(moves, index - 1), F.lit("+#"))
        return (index > 0) & F.endswith(skipped, mover_rank) & (beyond == previous)

    def gain(move: Column, index: Column) -> Column:
        won = F.when(passing(move, index), PIECE_VALUES["P"]).otherwise(taken(move, index))
        landed = F.get(pieces, index * 2)
        promoted = F.rlike(move, F.lit("^[a-h]")) & (landed != "P")
        return F.when(F.contains(move, F.lit("x")), won).otherwise(0) + F.when(
            promoted, _value(landed) - PIECE_VALUES["P"]
        ).otherwise(0)

    return F.transform(moves, gain)


def changing(changes: Column) -> Column:
    """Indexes of the moves that change the material, which are few."""
    plies = F.when(F.size(changes) > 0, F.sequence(F.lit(0), F.size(changes) - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(plies, lambda i: F.get(changes, i) != 0)


def balance_before(changes: Column, moved: Column) -> Column:
    """Material balance before every move, from the mover's view; ``moved`` is the column of :func:`changing`.

    The balance is summed over the moves with a change and repeated in between, as an array
    that grows by every move would be copied as often.
    """

    def signed(index: Column, value: Column) -> Column:
        return F.when(index % 2 == 0, value).otherwise(-value)

    def add(seen: Column, index: Column) -> Column:
        return F.array_append(seen, F.element_at(seen, -1) + signed(index, F.get(changes, index)))

    def constant(total: Column, index: Column) -> Column:
        last, first = F.coalesce(F.get(moved, index), F.size(changes) - 1), F.coalesce(F.get(moved, index - 1), F.lit(-1))
        return F.array_repeat(total, last - first)

    # from the first mover's view
    totals = F.aggregate(moved, F.array(F.lit(0)), add)
    return F.transform(F.flatten(F.transform(totals, constant)), lambda total, index: signed(index, total))


def gives_check(move: Column) -> Column:
    return F.coalesce(move.rlike("[+#]$"), F.lit(False))
