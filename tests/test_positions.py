import re
import uuid

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from plymill.plans import positions

GAME = "game_id string, moves_san array<string>, clock_seconds array<int>, time_control_type string, year int, white_elo int, black_elo int"


def played(spark, text, **options):
    moves = text.split()
    games = spark.createDataFrame([("g", moves, [60] * 3, "blitz", 2024, 1500, 1600)], GAME)
    return positions.played_positions(games, **options).orderBy("ply_number").collect()


def balances(spark, text):
    return [row["material_balance"] for row in played(spark, text)]


def test_plain_capture_and_recapture(spark):
    rows = played(spark, "e4 e5 Nf3 Nc6 Bb5 a6 Bxc6 dxc6 O-O")
    assert [r["material_balance"] for r in rows] == [0, 0, 0, 0, 0, 0, 0, -320, -10]
    assert [r["square"] for r in rows][-3:] == ["c6", "c6", "g1"]
    assert [r["player_elo"] for r in rows][:2] == [1500, 1600]
    assert [r["time_remaining_seconds"] for r in rows][:4] == [60, 60, 60, None]


def test_promotion_counts_capture_and_new_piece(spark):
    # bxa8=Q takes a rook (500) and gains 800, gxh1=Q does the same
    assert balances(spark, "a4 h5 a5 h4 a6 h3 axb7 hxg2 bxa8=Q gxh1=Q") == [0, 0, 0, 0, 0, 0, 0, -100, 0, -1300]
    assert balances(spark, "a4 h5 a5 h4 a6 h3 axb7 hxg2 bxa8=Q gxh1=Q Nc3")[-1] == 0


def test_en_passant_takes_a_pawn(spark):
    # exd6 e.p., then the pawn on d6 is retaken
    assert balances(spark, "e4 Nf6 e5 d5 exd6 exd6 Nf3") == [0, 0, 0, 0, 0, -100, 0]
    # black takes en passant on rank 3
    assert balances(spark, "a3 e5 a4 e4 d4 exd3 Bxd3 Nf6") == [0, 0, 0, 0, 0, 0, -100, 0]


def test_pawn_capture_of_a_piece_after_a_push_elsewhere(spark):
    # the knight on d6 is taken by a pawn; the push before was on another file
    assert balances(spark, "e4 Nc6 e5 Nb4 a3 Nd5 h3 Nb6 h4 a5 a4 Nc4 b3 Nd6 exd6 h5")[-1] == -320


def test_castled_rook_is_taken_on_its_new_square(spark):
    text = "d4 e5 dxe5 d6 exd6 Bxd6 Nc3 Be6 Bf4 Nc6 Qd2 Qf6 e3 O-O-O Bg5 Qg6 Bxd8 Kxd8 a3"
    # after Bxd8 white has won two pawns for one... plus the rook, then loses the bishop
    found = balances(spark, text)
    assert found[-3] == 100  # before Bxd8: two pawns taken, one lost
    assert found[-2] == -600  # the rook fell
    assert found[-1] == 270  # the bishop was retaken


def test_check_flag_follows_the_marked_move(spark):
    rows = played(spark, "e4 e5 Qh5 Nc6 Bc4 Nf6 Qxf7#")
    assert [r["is_in_check"] for r in rows] == [False] * 7
    assert [r["is_in_check"] for r in played(spark, "e4 d5 Bb5+ c6")] == [False, False, False, True]


def test_ply_cap_and_phases(spark):
    text = " ".join(["Nf3", "Nf6", "Ng1", "Ng8"] * 25)
    rows = played(spark, text, max_plies=80)
    assert len(rows) == 80
    assert [rows[i]["game_phase"] for i in (19, 20, 59, 60)] == ["opening", "middlegame", "middlegame", "endgame"]


@pytest.mark.parametrize("max_plies", [None, 200])
def test_loss_and_blunder(spark, max_plies):
    games = spark.createDataFrame(
        [("g", ["e4", "e5", "Nf3"], [5], "blitz", 2024, 1500, 1600), ("h", [], [], "blitz", 2024, 1, 2)], GAME
    )
    scores = spark.createDataFrame(
        [("g", 0, 40), ("g", 1, -220), ("g", 1, -220), ("g", 2, -230), (None, 0, 1), ("g", 500, 9), ("zz", 1, 3)],
        "game_id string, ply int, eval_cp int",
    )
    rows = positions.evaluated_positions(games, scores, max_plies=max_plies).orderBy("ply_number").collect()
    assert [(r["eval_before_cp"], r["eval_after_cp"], r["cp_loss"], r["is_blunder"]) for r in rows] == [
        (40, -220, 260, True),
        (220, 230, 0, False),
        (-230, None, None, None),
    ]


def test_sampling(spark):
    games = spark.range(2000).select(F.concat(F.lit("g"), "id").alias("game_id"), F.array(F.lit("e4")).alias("moves_san"))
    sampled = positions.sample_games(games, 0.1, seed=1)
    again = positions.sample_games(games.repartition(7), 0.1, seed=1)
    ids = {r[0] for r in sampled.select("game_id").collect()}
    assert ids == {r[0] for r in again.select("game_id").collect()}
    assert 120 < len(ids) < 280
    assert positions.sample_games(games, 1.0, max_games=5).count() == 5
    for wrong in (0, -1, 1.5):
        with pytest.raises(ValueError):
            positions.sample_games(games, wrong)


def test_whole_games_and_scored_counts(spark):
    """Moves past the 80th stay; a half-move without both scores is no evaluated position."""
    from plymill.plans import time_pressure

    moves = ["Nf3", "Nf6", "Ng1", "Ng8"] * 25
    game = [("g", moves, list(range(100, 0, -1)), "blitz", 2020, 1500, 1600)]
    games = spark.createDataFrame(
        game, "game_id string, moves_san array<string>, clock_seconds array<int>, time_control_type string, year int, white_elo int, black_elo int"
    )
    scores = spark.createDataFrame([("g", i, 10 * i) for i in range(101) if i != 50], "game_id string, ply int, eval_cp int")
    rows = positions.evaluated_positions(games, scores)
    assert rows.count() == 100 and rows.where("cp_loss is null").count() == 2
    assert rows.where("ply_number = 100").first()["eval_after_cp"] == -1000
    assert sum(r.evaluated_positions for r in time_pressure.position_quality(rows).collect()) == 98


def scored_games(spark):
    rows = [(f"g{i}", ["e4"] * (i % 4)) for i in range(40)] + [("none", None)]
    return spark.createDataFrame(rows, "game_id string, moves_san array<string>").repartition(5)


def engine(folder):
    """An opener whose resource leaves a file for each opening and closing; local, so that it travels to the workers."""

    class Engine:
        def __enter__(self):
            (folder / f"opened-{uuid.uuid4()}").touch()
            return self

        def __exit__(self, *_):
            (folder / f"closed-{uuid.uuid4()}").touch()

    return Engine


def scorer():
    def score(opened, game_id, moves):
        if game_id == "bad":
            raise RuntimeError("engine broke")
        return [(ply, 100 * ply) for ply in range(len(moves) + 1)]

    return score


def used(folder):
    return tuple(len(list(folder.glob(f"{kind}-*"))) for kind in ("opened", "closed"))


def test_scorer_opens_its_resource_once_per_partition(spark, tmp_path):
    found = positions.score_with(scored_games(spark), engine(tmp_path), scorer())
    rows = found.collect()
    assert len(rows) == sum(i % 4 + 1 for i in range(40)) + 1
    assert {(r.ply, r.eval_cp) for r in rows if r.game_id == "g7"} == {(0, 0), (1, 100), (2, 200), (3, 300)}
    assert used(tmp_path) == (5, 5)


def test_scorer_closes_its_resource_on_failure(spark, tmp_path):
    broken = scored_games(spark).limit(3).unionByName(spark.createDataFrame([("bad", ["e4"])], "game_id string, moves_san array<string>"))
    with pytest.raises(PythonException, match="engine broke"):
        positions.score_with(broken.coalesce(1), engine(tmp_path), scorer()).collect()
    opened, closed = used(tmp_path)
    assert opened == closed > 0
    assert positions.score_with(broken.limit(0), engine(tmp_path), scorer()).count() == 0
    assert used(tmp_path) == (opened, closed)


def test_score_lists_are_the_scores_by_game_and_no_list_is_shuffled(spark, small, capsys):
    from plymill import catalog
    from plymill.sources import tables

    rows = catalog.plain_games(spark, small)
    by_list = positions.evaluated_positions(rows, tables.score_lists(spark, small))
    by_row = positions.evaluated_positions(rows, tables.evaluations(spark, small))
    columns = ["game_id", "ply_number", "square", "eval_before_cp", "eval_after_cp", "cp_loss", "is_blunder"]
    by_list, by_row = by_list.select(columns), by_row.select(columns)
    assert by_list.filter("cp_loss > 0").count() > 1000
    assert by_list.exceptAll(by_row).isEmpty() and by_row.exceptAll(by_list).isEmpty()
    catalog.evaluated(spark, small).explain("formatted")
    shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert shuffled and not any("scores" in names or "eval_cp" in names for names in shuffled)


def test_texts_are_parsed_once_under_the_explode(spark, small, capsys):
    from plymill import catalog

    for rows in (positions.played_positions(catalog.plain_games(spark, small)), catalog.evaluated(spark, small)):
        rows.select("ply_number", "move").explain("simple")
        assert capsys.readouterr().out.count("regexp_replace") < 20
    assert played(spark, "") == []


def test_only_narrow_rows_are_shuffled_by_game(spark, small, capsys):
    from plymill import catalog
    from plymill.plans import bronze
    from plymill.sources import tables

    for rows in (catalog.evaluated(spark, small), catalog.pressure(spark, small), catalog.bronze(spark, small)):
        rows.explain("formatted")
        shuffled = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)
        assert shuffled and not any(re.search(r"\b(min|row|moves\w*|clock_\w+)#", names) for names in shuffled)
    dealt, plain = catalog.bronze(spark, small), bronze.bronze_games(tables.raw_games(spark, small))
    assert dealt.count() == plain.count() and dealt.exceptAll(plain).isEmpty()
