import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plymill.functions import moves as M
from plymill.functions import scalars as S
from plymill.functions import sqlfuncs, text

BLOCK = """[Event "Rated Blitz game"]
[Site "https://games.example/abc123"]
[Date "2024.01.01"]
[White "somebody"]
[White "alice"]
[Black "bob"]
[Result "1-0"]
[WhiteElo "1500"]
[ECO "B20"]
[Opening "Sicilian \\"quoted\\" Defense"]
[TimeControl "300+0"]

1. e4 { [%clk 0:05:00] } c5
2. Nf3 d6 1-0
"""


def test_scalars(values):
    assert values(S.normalise_result, "string", "1-0", "0-1", "1/2-1/2", "*", None) == [
        "white_win", "black_win", "draw", None, None,
    ]
    assert values(S.result_reason, "string", "Time forfeit", "Normal", "Abandoned", " Odd End ", None) == [
        "timeout", "checkmate_or_resignation", "abandoned", "odd_end", None,
    ]
    assert values(S.parse_rating, "string", "?", "1500", "399", "3501", " 1400 ", "x", "", None) == [
        None, 1500, None, None, 1400, None, None, None,
    ]
    parsed = values(S.parse_time_control, "string", "300+0", "60+0", "99999+1", "correspondence", "-", "", "x+1", None)
    assert [(p[0], p[1], p[3]) for p in parsed] == [
        (300, 0, "blitz"), (60, 0, "bullet"), (99999, 1, "classical"), (None, None, "correspondence"),
        (None, None, None), (None, None, None), (None, None, None), (None, None, None),
    ]
    huge = values(S.parse_time_control, "string", "2147483647+2147483647")[0]
    assert huge[0] == 2147483647 and huge[2] is None
    assert values(S.parse_clock, "string", "0:05:00", "05:03", "5.9", "1:2:3:4", "a:b", "999999:0:0", None) == [
        300, 303, 5, None, None, None, None,
    ]
    assert values(S.parse_clocks, "string", "0:00:05 bad 0:00:16 1:02:03", "", None) == [[5, 16, 3723], [], []]
    assert values(S.dropped_clock_tokens, "string", "0:00:05 bad x:1", "", None) == [2, 0, 0]
    assert values(S.time_left_bucket, "int", 5, 6, 16, 31, 61, None) == ["0-5s", "6-15s", "16-30s", "31-60s", "60s+", None]
    assert values(S.phase_of_ply, "int", 20, 21, 60, 61) == ["opening", "middlegame", "middlegame", "endgame"]
    assert values(S.parse_game_date, "string", "2024.01.02", "????.??.??", None) == [dt.date(2024, 1, 2), None, None]
    assert values(S.is_bot, "string", "stockfishBOT", "alice", "Botany", None) == [True, False, False, False]
    assert values(S.opening_variation, "string", "A: B : C ", "A", None) == ["B : C", "A", None]
    assert values(S.opening_family, "string", "A: B : C ", "A") == ["A", "A"]
    assert values(S.previous_period, "string", "2024-01", "2024-10") == ["2023-12", "2024-09"]
    assert values(S.rating_label, "int", 1500, 1600, 1700, 2200, 2800, 400, None) == [
        "1400-1600", "1600-1800", "1600-1800", "2200+", "2200+", "400-600", None,
    ]


def test_rating_bucket_needs_one_rating(spark):
    rows = spark.createDataFrame([(1500, 1610), (None, 1610), (1999, 2001), (None, None)], "w int, b int")
    found = [r[0] for r in rows.coalesce(1).select(S.rating_bucket(F.col("w"), F.col("b"))).collect()]
    assert found == ["1400-1600", "1600-1800", "2200+", None]


def test_phase_of_move(spark):
    rows = spark.createDataFrame([(5, 32), (20, 28), (12, 18), (40, None), (None, 3)], "m int, p int").coalesce(1)
    found = [r[0] for r in rows.select(S.phase_of_move(F.col("m"), F.col("p"))).collect()]
    assert found == ["opening", "middlegame", "endgame", "endgame", None]


@pytest.mark.parametrize(
    "given_text, expected",
    [
        ("1. e4 {comment} e5 2. Nf3 Nc6 1-0", "e4 e5 Nf3 Nc6"),
        ("1. e4 e5 2. Nf3 Nc6 (2... d6) 3. Bb5 a6 4. Bxc6?! dxc6 5. O-O *", "e4 e5 Nf3 Nc6 Bb5 a6 Bxc6 dxc6 O-O"),
        ("1. a4 h5 2. a5 h4 3. a6 h3 4. axb7 hxg2 5. bxa8=Q gxh1=Q *", "a4 h5 a5 h4 a6 h3 axb7 hxg2 bxa8=Q gxh1=Q"),
        ("1. e4 $1 (1. d4 (1. c4 (1. f4)) d5) e5!! ...Nf3 ?!", "e4 e5 Nf3"),
        ("1. e4 e5 ; the rest is a comment 2. Nf3", "e4 e5"),
        ("1. e4 e5 2. Zz9 Nf6", "e4 e5"),
        ("garbage", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_parse_moves(values, given_text, expected):
    wanted = expected.split()
    assert values(M.parse_moves, "string", given_text) == [wanted]


def test_stepwise_moves_match_the_column_function(spark):
    texts = ["1. e4 (1. d4 (1. c4)) e5 2. Nf3! Nc6 1-0", "1. d4 d5 2. zz", None, "", "((", "1-0", "* e4"]
    frame = spark.createDataFrame([(t,) for t in texts], "moves string")
    both = M.with_moves(frame).select("moves_san", M.parse_moves(F.col("moves")).alias("direct"), "features")
    for row in both.collect():
        assert row["moves_san"] == row["direct"]
        assert row["features"]["legal_prefix_length"] == len(row["direct"])


def test_move_features(values):
    moves = "e4 e5 Nf3 Nc6 Bb5 a6 Bxc6 dxc6 O-O".split()
    found = values(M.move_features, "array<string>", moves, [])
    assert tuple(found[0]) == (True, 2, True, False, 9)
    assert tuple(found[1]) == (False, 0, False, False, 0)


def test_parse_block(spark):
    stamp = dt.datetime(2024, 2, 1, 12)
    no_site = BLOCK.replace('[Site "https://games.example/abc123"]\n', "").replace('[Date "2024.01.01"]\n', "")
    frame = spark.createDataFrame([(BLOCK,), (no_site.replace("\n", "\r\n"),)], "block string").coalesce(1)
    first, second = text.parse_blocks(frame, batch_id="2024-01", ingested_at=stamp).collect()
    assert first["game_id"] == "abc123"
    assert first["white"] == "alice"  # the last tag wins
    assert first["opening"] == 'Sicilian \\"quoted\\" Defense'
    assert first["utc_date"] == "2024.01.01"
    assert first["moves"] == "1. e4 { [%clk 0:05:00] } c5 2. Nf3 d6"
    assert first["clock_annotations"] == "0:05:00"
    assert first["ingested_at"] == stamp and first["batch_id"] == "2024-01" and first["source"] == "batch"
    assert second["game_id"] is None and second["utc_date"] is None
    assert second["moves"] == first["moves"]


def test_id_of_url(values):
    assert values(text.id_of_url, "string", "https://x/y/", "abc", "///", "", None) == ["y", "abc", None, None, None]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aeO-x+#1(){}; .$!?*NQ=8", max_size=30), min_size=1, max_size=8))
def test_any_text_parses_to_a_prefix_of_its_tokens(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select(M.parse_tokens(F.col("t")).alias("all"), M.parse_moves(F.col("t")).alias("good")).collect():
        assert row["all"][: len(row["good"])] == row["good"]
        assert "" not in row["all"]


def test_sql_functions(spark):
    names = sqlfuncs.register(spark)
    assert len(names) == 9
    row = spark.sql(
        "select ply_normalize_result('1-0'), ply_parse_elo('399'), ply_elo_bucket(1500, 1610), ply_elo_bucket(null, 2100),"
        " ply_parse_clock_seconds('0:00:05 x 5'), ply_parse_moves('1. e4 {c} (1. d4 (d5)) e5! 2. Zz Nf3'),"
        " ply_classify_game_phase(12, 18), ply_result_reason('Time forfeit'), ply_parse_san_tokens(null)"
    ).first()
    assert list(row) == ["white_win", None, "1400-1600", "2200+", [5, 5], ["e4", "e5"], "endgame", "timeout", []]
    with pytest.raises(ValueError):
        sqlfuncs.run_select(spark, "drop table x")
    spark.sql("create or replace temporary view written_to as select 1 as a")
    with pytest.raises(ValueError):
        sqlfuncs.run_select(spark, "with t as (select 1 as a) insert into written_to select a from t")
    assert sqlfuncs.run_select(spark, "with a as (select 1 as x) select * from a").count() == 1


@pytest.mark.parametrize(
    "query",
    [
        "select reflect('java.lang.System', 'setProperty', 'zz', '1')",
        "select `reflect` ('java.lang.System', 'getProperty', 'zz')",
        "with a as (select Java_Method('java.util.UUID', 'randomUUID') as x) select * from a",
        "select /* ' */ try_reflect('java.lang.System', 'exit', 1) -- '",
        "select r'\\', reflect('java.lang.System', 'exit') as \"'\"",
        "select transform(a) using 'cat' as (b) from (select 1 as a)",
        "select * from csv.`/etc/passwd`",
        "select * from text . `file:///etc/hostname`",
        "explain select 1",
    ],
)
def test_queries_cannot_run_code_or_read_files(spark, query):
    with pytest.raises(ValueError):
        sqlfuncs.run_select(spark, query)


def test_harmless_queries_pass(spark):
    rows = sqlfuncs.run_select(spark, "select 'reflect(1) using \\'x\\' csv./a' as a, transform(array(1, 2), x -> x + 1) as b, 1.5 as json -- reflect(")
    assert rows.first()["b"] == [2, 3]
    assert sqlfuncs.run_select(spark, "select * from (values (1), (2)) a(x) join (values (1)) b(x) using (x)").count() == 1


def largest_method(spark, df):
    """Bytes of the largest method that Spark generates for a plan; the JIT compiler leaves those of over 8000 alone."""
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = debug.codegenStringSeq(df.select("*")._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    return max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size()))


def test_rows_are_made_and_parsed_by_compiled_code(spark, small):
    from plymill.sources import tables

    assert 0 < largest_method(spark, tables.raw_games(spark, small)) <= 8000
    blocks = tables.game_blocks(spark, small)
    assert 0 < largest_method(spark, text.parse_blocks(blocks, batch_id="b", judged=True)) <= 8000


def test_spark_rules_make_the_rows_of_the_plain_rules(spark, small, monkeypatch):
    from plymill.sources import tables

    rows = tables.raw_games(spark, small)
    monkeypatch.setattr(tables, "SPARK_RULES", tables.RAW_RULES)
    plain = tables.raw_games(spark, small)
    assert rows.count() == plain.count() and rows.exceptAll(plain).isEmpty()


def test_closing_result_and_repeated_tags(spark):
    rows = ['[White "a"]\n[White "b"]\n\n1. e4 1-0', "1-0", "x1-0", "e4 1/2-1/2 *", '[Site "u/1"]\n', None]
    found = text.parse_blocks(spark.createDataFrame([(r,) for r in rows], "block string").coalesce(1), batch_id="b")
    assert [tuple(r) for r in found.select("game_id", "white", "moves").collect()] == [
        (None, "b", "1. e4"), (None, None, ""), (None, None, "x1-0"), (None, None, "e4 1/2-1/2"), ("1", None, ""), (None, None, None),
    ]
