"""One ANSI SQL statement per registered query that SQL can express."""

from __future__ import annotations

from oracle.ctes import (
    PHASE,
    REASON,
    RESULT,
    TERMINATION,
    TIME_LEFT,
    bucket,
    clean,
    label,
    noise,
    parse_clock,
    prefix,
    r,
    r6,
    rating,
    tokens,
    with_,
)

ORACLE: dict[str, str] = {}


def add(name: str, ctes: list[str], sql: str) -> None:
    ORACLE[name] = with_(ctes, sql)


def tally(name: str, ctes: list[str], sql: str) -> None:
    add(name, ctes, f"select *, count(*) as n from ({sql}) group by all")


OPENING_KEYS = "eco_code, opening_family, elo_bucket, time_control_type, year"
RATES = f"{r6('white_win_rate')} as white_win_rate, {r6('black_win_rate')} as black_win_rate, {r6('draw_rate')} as draw_rate"
OPENING_ROW = f"{OPENING_KEYS}, games_count, {RATES}, {r6('avg_game_length')} as avg_game_length, most_common_response"
PLAYER_ROW = (
    f"player, year, month, games_played, wins, losses, draws, {r6('win_rate')} as win_rate, {r6('avg_elo')} as avg_elo,"
    " elo_change, most_played_opening_white, most_played_opening_black"
)
PRESSURE_ROW = (
    "time_remaining_bucket, game_phase, time_control_type, year, games_count, evaluated_positions, blunder_count,"
    f" {r6('avg_cp_loss')} as avg_cp_loss, {r6('blunder_rate')} as blunder_rate"
)
STYLE_FLOATS = [
    "win_rate", "loss_rate", "draw_rate", "avg_elo", "avg_game_length", "avg_capture_count", "capture_game_rate",
    "castle_rate", "top_opening_share", "bullet_share", "blitz_share", "rapid_share", "classical_share", "clock_game_rate",
]
STYLE = [
    "win_rate", "loss_rate", "draw_rate", "avg_elo", "elo_change_proxy", "avg_game_length", "avg_capture_count",
    "capture_game_rate", "castle_rate", "opening_diversity", "top_opening_share", "bullet_share", "blitz_share",
    "rapid_share", "classical_share", "clock_game_rate",
]

# ---- sources and sinks

_TEXT = "case when moves is null then result when moves like '%*' then moves else moves || ' ' || result end"
_PARSED = rf"""select *, trim(regexp_replace({_TEXT}, '(^|\s)(1-0|0-1|1/2-1/2|\*)$', '')) as parsed from raw"""
_CLOCKS = r"nullif(array_to_string(regexp_extract_all({m}, '\[%clk\s+([^\]]+)\]', 1), ' '), '')"
_BLOCKS = f"select * exclude (moves), parsed as moves, {_CLOCKS.format(m='parsed')} as clocks from ({_PARSED})"

tally(
    "s01_split_game_texts",
    ["raw"],
    f"select game_id, white, black, result, utc_date, moves, clocks as clock_annotations from ({_BLOCKS})",
)
tally(
    "s02_compressed_game_texts", ["raw"],
    f"select result, termination, cast(length(moves) as integer) as move_chars from ({_BLOCKS})",
)
add("s03_landing_files", ["raw"], "select count(*) as n_rows, true as within_limit from raw")
tally("s04_landing_scan", ["raw"], "select batch_id, source, result from raw")
tally("s05_partitioned_sink", ["plain"], "select year, month from plain")
add("s06_month_partition", ["plain"], "select game_id, result, year, month from plain where year = 1998 and month = 3")
tally("s07_reference_csv", ["reference"], "select eco, name from reference")
add("s08_lake_views", ["games"], "select year, month, count(*) as n from games group by 1, 2")
tally("s09_empty_placeholder", ["openings"], "select eco_code, year from openings")
tally("s10_default_columns", ["played"], "select square, cast(null as integer) as year, game_phase from played")
add("s11_presentation_views", ["players"], f"select {PLAYER_ROW} from players")
_PREV = "case when lag(year * 12 + month) over t = year * 12 + month - 1 then lag({c}) over t end"
_PERIOD = "year || '-' || lpad(month::varchar, 2, '0')"
add(
    "s12_metrics_history",
    ["months"],
    f"select {_PERIOD} as period, silver_count, {_PREV.format(c='silver_count')} as prev_silver_count from months"
    " window t as (order by year, month)",
)
_BATCHES = (
    "select batch_id, count(*) as games_seen, count(*) filter (coalesce(game_id, '') = '') as missing_game_id,"
    " count(*) filter (coalesce(moves, '') = '') as missing_moves from raw group by 1"
)
add("s13_diagnostics_scan", ["raw"], _BATCHES)
add(
    "s14_month_coverage",
    ["plain"],
    """select strftime(m, '%Y-%m') as period, count(game_id) as rows,
      case when count(game_id) > 0 then 'success' else 'missing' end as status
    from (select unnest(generate_series(date '1994-11-01', date '2002-02-01', interval 1 month)) as m)
    left join plain on year = year(m) and month = month(m) group by m""",
)
add("s15_csv_export", ["openings"], f"select {OPENING_ROW} from openings")

# ---- columns

tally(
    "p01_tag_columns",
    ["raw"],
    "select game_id, white, black, result, white_elo, black_elo, eco, opening, time_control, utc_time from raw",
)
tally("p02_move_text", ["raw"], f"select moves from ({_BLOCKS})")
tally("p03_clock_comments", ["raw"], f"select {_CLOCKS.format(m='moves')} as clocks, result from raw")
_LAST = "nullif(regexp_extract({u}, '([^/]*)/*$', 1), '')"
tally("p04_id_of_url", [], f"select url, {_LAST.format(u='url')} as page, {_LAST.format(u='url')} as page2 from pages")
tally(
    "p05_date_fallback", ["raw"],
    "select coalesce(nullif(case when source = 'stream' then '' when white_elo <> '?' then utc_date end, ''), batch_id)"
    " as day from raw",
)
tally("p06_ingest_stamps", ["raw"], "select '2024-01' as batch_id, 'batch' as source, true as stamped from raw")
tally("p07_result", ["raw"], f"select result, {RESULT} as parsed from raw")
tally("p08_termination", ["raw"], f"select termination, {TERMINATION} as parsed from raw")
tally("p09_result_reason", ["raw"], f"select termination, {REASON} as parsed from raw")
tally("p10_rating", ["raw"], f"select white_elo, {rating('white_elo')} as parsed from raw")
tally("p24_bot_name", ["raw"], "select white, coalesce(regexp_matches(white, '(?i)bot$'), false) as parsed from raw")
tally("p25_opening_family", ["raw"], "select opening, split_part(opening, ':', 1) as parsed from raw")
tally(
    "p40_previous_month", ["raw"],
    "select batch_id, strftime(cast(batch_id || '-01' as date) - interval 1 month, '%Y-%m') as parsed from raw",
)
tally(
    "p15_clean_tokens", ["raw"],
    f"select moves, array_to_string(list_transform(string_split(moves, ' '), lambda t: {clean('t')}), ' ') as parsed from raw",
)
tally("p14_strip_noise", ["raw"], f"select moves, {noise('moves')} as parsed from raw")
tally("p16_move_tokens", ["raw"], f"select moves, array_to_string({tokens('moves')}, ' ') as parsed from raw")
_BARE = f"select *, {tokens('moves')} as bare from raw"
_SAN = f"select *, {prefix('bare')} as san from ({_BARE})"
tally("p17_valid_prefix", ["raw"], f"select moves, array_to_string(san, ' ') as parsed from ({_SAN})")
tally(
    "p18_captures", ["raw"],
    f"select moves, cast(len(list_filter(san, lambda m: contains(m, 'x'))) as integer) as parsed from ({_SAN})",
)
_SECONDS = (
    "coalesce(list_filter(list_transform(string_split_regex(trim(clock_annotations), '\\s+'),"
    f" lambda t: {parse_clock('t')}), lambda s: s is not null), [])"
)
tally("p13_clock_list", ["raw"], f"select clock_annotations, array_to_string({_SECONDS}, ' ') as parsed from raw")
tally("p21_game_date", ["raw"], "select utc_date, try_cast(replace(utc_date, '.', '-') as date) as parsed from raw")
tally(
    "p11_time_control", ["raw"],
    r"""select time_control, base as base_seconds, inc as increment_seconds, base + 40 * inc as estimated_total,
      case when lower(time_control) = 'correspondence' then 'correspondence' when base + 40 * inc <= 179 then 'bullet'
        when base + 40 * inc <= 479 then 'blitz' when base + 40 * inc <= 1499 then 'rapid'
        when base + 40 * inc is not null then 'classical' end as time_control_type
    from (select time_control, try_cast(regexp_extract(time_control, '^(\d+)\+(\d+)$', 1) as integer) as base,
      try_cast(regexp_extract(time_control, '^(\d+)\+(\d+)$', 2) as integer) as inc from raw)""",
)
tally(
    "p12_clock", ["raw"],
    f"select token, {parse_clock('token')} as seconds from"
    " (select unnest(string_split_regex(trim(clock_annotations), '\\s+')) as token from raw)",
)
tally(
    "p19_castling", ["raw"],
    f"""select len(list_filter(san, lambda m, i: m like 'O-O%' and i % 2 = 1)) > 0 as white_castled,
      len(list_filter(san, lambda m, i: m like 'O-O%' and i % 2 = 0)) > 0 as black_castled from ({_SAN})""",
)
tally("p20_length_and_clock_flag", ["plain"], "select game_length, legal_prefix_length, has_clock_data from plain")
tally(
    "p22_rating_bucket", ["raw"],
    f"select w, b, {bucket('w', 'b')} as bucket from (select {rating('white_elo')} as w,"
    f" case when {rating('black_elo')} % 3 <> 0 then {rating('black_elo')} end as b from raw)",
)
tally(
    "p23_numeric_rating_bucket", ["plain"],
    "select floor(((white_elo + black_elo) / 2) / 200) * 200 as bucket from plain",
)
tally("p26_first_existing_column", ["reference"], "select eco, name from reference")
_READINGS = f"select unnest(s) as seconds, cast(generate_subscripts(s, 1) as integer) as ply from (select {_SECONDS} as s from raw)"
tally(
    "p27_time_left_bucket", ["raw"],
    f"select {TIME_LEFT.format(s='s2')} as bucket from (select case when seconds <> 59 then seconds end as s2 from ({_READINGS}))",
)
tally("p28_phase_of_ply", ["raw"], f"select ply, {PHASE.format(ply='ply')} as phase from ({_READINGS})")
tally(
    "p29_phase_of_move", [],
    """select *, case when move_number is null then null when piece_count <= 20 then 'endgame'
      when move_number <= 10 then 'opening' when move_number <= 30 then 'middlegame' else 'endgame' end as phase
    from (select case when l_partkey % 13 <> 0 then cast(l_quantity as integer) end as move_number,
      case when l_suppkey % 4 <> 0 then cast(l_suppkey % 33 as integer) end as piece_count from lineitem)""",
)
tally(
    "p30_winner", ["plain"],
    "select result, case result when 'white_win' then white when 'black_win' then black end as winner from plain",
)
tally(
    "p31_surrogate_keys", ["raw"],
    "select eco, md5(coalesce(eco, '')) as one, md5(coalesce(eco, '') || '|' || coalesce(opening, '') || '|' ||"
    " coalesce(time_control, '')) as three from raw",
)
add("p32_staged_games", ["staged"], "select * exclude (clock_seconds, moves_san) from staged")
tally("p33_period_label", ["plain"], f"select year, month, {_PERIOD} as period from plain")
add(
    "p34_outcome_long", ["openings"],
    f"""select eco_code, opening_family, 'White wins' as outcome, {r6('white_win_rate')} as rate from openings
    union all select eco_code, opening_family, 'Black wins', {r6('black_win_rate')} from openings
    union all select eco_code, opening_family, 'Draws', {r6('draw_rate')} from openings""",
)
add(
    "p35_display_order", ["clocks"],
    """select time_remaining_bucket, game_phase, time_control_type,
      cast(list_position(['0-5s', '6-15s', '16-30s', '31-60s', '60s+'], time_remaining_bucket) as integer) as bucket_rank,
      cast(list_position(['opening', 'middlegame', 'endgame'], game_phase) as integer) as phase_rank,
      sum(games_count)::bigint as games_count from clocks group by 1, 2, 3""",
)
tally(
    "p36_rating_difference", ["plain"],
    "select (white_elo - black_elo)::double as elo_diff, abs(white_elo - black_elo)::double as abs_elo_diff from plain"
    " where white_elo is not null and black_elo is not null",
)


def _percent(c: str) -> str:
    return f"printf('%.1f', round({c} * 100, 1))"


def opening_sentences(least: int, limit: int | None = None) -> str:
    order = f"games_count desc, {', '.join(k.strip() + ' nulls first' for k in OPENING_KEYS.split(','))}"
    return f"""select 'op_' || (row_number() over (order by {order}) - 1) as doc_id,
      coalesce(opening_family, 'unknown') || ' [' || coalesce(eco_code, 'unknown') || '], players rated '
      || coalesce(elo_bucket, 'unknown') || ', ' || coalesce(time_control_type, 'unknown') || ' games: '
      || format('{{:,}}', games_count) || ' played. First side won ' || {_percent('white_win_rate')} || '%, second side '
      || {_percent('black_win_rate')} || '%, drawn ' || {_percent('draw_rate')} || '%. Mean length '
      || printf('%.0f', round(avg_game_length, 0)) || ' half-moves.' as text
    from (select * from openings where games_count >= {least} order by {order} limit {limit or 10**9})"""


PLAYER_SENTENCES = f"""select 'pl_' || (row_number() over (order by total_games desc, player) - 1) as doc_id,
      player || ' played ' || format('{{:,}}', total_games) || ' games at a mean rating of '
      || coalesce(printf('%.0f', elo), 'unknown') || ' and won ' || printf('%.1f', win_pct) || '% of them.'
      || coalesce(' As first side mostly ' || w || '.', '') || coalesce(' As second side mostly ' || b || '.', '') as text
    from (select player, sum(games_played)::bigint as total_games, {r('avg(avg_elo)', 0)} as elo,
      {r('avg(win_rate) * 100', 1)} as win_pct, min(most_played_opening_white) as w, min(most_played_opening_black) as b
      from players group by 1 having sum(games_played) >= 30 order by 2 desc, 1)"""

add("p37_opening_sentences", ["openings"], opening_sentences(5))
add(
    "p38_mart_player_profile", ["players"],
    f"""select player, year, month, games_played::bigint as games_played, wins::bigint as wins, losses::bigint as losses,
      draws::bigint as draws, {r6('win_rate')} as win_rate, {r6('avg_elo')} as avg_elo, elo_change::double as elo_change,
      most_played_opening_white, most_played_opening_black from players""",
)
add(
    "p38_mart_opening_analysis", ["openings"],
    f"select * replace (games_count::bigint as games_count) from (select {OPENING_ROW} from openings where eco_code is not null)",
)
add(
    "p38_mart_time_pressure", ["pressure"],
    "select * replace (games_count::bigint as games_count, evaluated_positions::bigint as evaluated_positions,"
    f" blunder_count::bigint as blunder_count) from (select {PRESSURE_ROW} from pressure)",
)
add(
    "p39_enriched_results", ["staged"],
    """select game_id, white_player, black_player, white_elo, black_elo, result,
      case result when 'white_win' then white_player when 'black_win' then black_player end as winner,
      floor(((white_elo + black_elo) / 2) / 200) * 200 as elo_bucket, eco_code, opening_family, opening_variation,
      time_control_type, game_date, year, month, game_length, has_clock_data from staged""",
)
tally("p41_rating_label", [], f"select {label('cast(o_custkey % 3100 + 400 as integer)')} as label from orders")

# ---- filters

tally("f01_bronze_rejects", ["raw"], "select white, black, result, 'null_game_id' as reject_reason from raw where game_id is null")
_MISSING = " || ".join(
    f"case when {c} is null then ',{c}' else '' end" for c in ("game_id", "white", "black", "result", "year", "month")
)
add(
    "f02_silver_quarantine", ["candidates"],
    f"select * from (select game_id, white, result, year, month, 'null_required_column' as reject_reason,"
    f" substr({_MISSING}, 2) as missing from candidates) where missing <> ''",
)
_SLIM = "game_id, white, white_elo, black_elo, game_length"
_CASES = {
    "f03_without_bots": "not has_bot_player",
    "f04_rated_only": "white_elo is not null and black_elo is not null",
    "f05_without_corrupt": "(not had_moves or game_length > 0)",
}
_CASES["c02_silver_all_filters"] = " and ".join(_CASES.values())
for _name, _where in _CASES.items():
    add(
        _name, ["plain_candidates"],
        f"select {_SLIM} from plain_candidates where result is not null and year is not null and {_where}",
    )
add(
    "f06_batch_and_month", ["bronze", "plain"],
    "select (select count(*) from bronze where batch_id = '1997-05') as bronze_count,"
    " (select count(*) from plain where year = 1997 and month = 5) as silver_count",
)
_STAT_ORDER = "games_count desc, eco_code nulls first, opening_family nulls first, elo_bucket nulls first, time_control_type nulls first, year"
add(
    "f07_optional_predicates", ["stats"],
    "select * from stats where eco_code = 'B02' and opening_family ilike '%conom%' and year = 1998"
    f" order by {_STAT_ORDER} limit 40",
)
add("f08_player_any_case", ["players"], f"select {PLAYER_ROW} from players where lower(player) = 's17'")
add(
    "f09_hash_sample", ["bronze"],
    "select game_id from bronze where ('0x' || substr(md5('7:' || game_id), 1, 8))::bigint / 4294967296.0::double < 0.05",
)
tally(
    "f10_games_with_clocks", ["plain"],
    "select time_control_type, cast(len(clock_seconds) as integer) as readings from plain where has_clock_data",
)
add("f11_group_threshold", ["style"], "select player, games_played from style where games_played >= 40")

# ---- joins

add("j01_opening_dimension", ["dim"], "select * from dim")
tally("j02_enriched_openings", ["games"], "select eco_code, opening_family, opening_variation from games")
add("j03_time_pressure", ["pressure"], f"select {PRESSURE_ROW} from pressure")
add(
    "j04_player_opening_summary", ["seats"],
    """select player, sum(n)::bigint as games_played, count(eco_code) as opening_diversity,
      coalesce(max(case when eco_code is not null then n end), 0) as top_opening_games
    from (select player, eco_code, count(*) as n from seats group by 1, 2) group by 1""",
)
tally(
    "j05_label_map", [],
    """select (c_custkey % 6)::int as cluster, case c_custkey % 6 when 0 then 'Bullet Specialists'
      when 1 then 'Blitz Specialists' when 2 then 'Long-Game Grinders' when 3 then 'Opening Loyalists'
      when 4 then 'Opening Explorers' end as style_label from customer""",
)
add(
    "j06_orphan_keys", ["seats"],
    "select distinct player as key from seats where player not in (select 'c' || c_custkey from customer union all select 's' || s_suppkey from supplier)",
)
add(
    "j07_board_grid", ["heatmap"],
    f"""select file || rank as square, file, rank, coalesce(blunders, 0)::double as value,
      {r6("coalesce(coalesce(blunders, 0) / nullif((select max(blunders) from heatmap), 0), 0)::double")} as intensity
    from (select unnest(string_split('abcdefgh', '')) as file), (select unnest(range(1, 9))::int as rank)
    left join heatmap on square = file || rank""",
)

# ---- aggregations

add("a01_dedupe", ["bronze"], "select * exclude (ingested_at, moves, clock_annotations) from bronze")
add(
    "a02_bronze_diagnostics", ["raw"],
    """select count(*) as input_count, count(*) filter (game_id is null) as missing_game_id,
      (select count(*) from (select game_id from raw where game_id is not null group by 1 having count(*) > 1))
        as duplicate_game_ids,
      count(game_id) - count(distinct game_id) as duplicate_rows_removed, count(distinct game_id) as output_count,
      count(*) - count(distinct game_id) as rows_removed, count(*) filter (game_id is null) as quarantine_count
    from raw""",
)
add("a02_bronze_partitions", ["bronze"], "select batch_id, source, count(*) as n from bronze group by 1, 2")
add(
    "a03_parser_diagnostics", ["raw"],
    """select *, broken_tags + without_tags as parse_errors,
      missing_game_id + missing_players + missing_result + missing_moves + broken_tags + without_tags as suspicious_rows
    from (select count(*) as games_seen, count(*) filter (why = '') as rows_written,
      count(*) filter (why = '' and coalesce(game_id, '') = '') as missing_game_id,
      count(*) filter (why = '' and (coalesce(white, '') = '' or coalesce(black, '') = '')) as missing_players,
      count(*) filter (why = '' and coalesce(result, '') = '') as missing_result,
      count(*) filter (why = '' and coalesce(moves, '') = '') as missing_moves,
      count(*) filter (why = 'cut') as broken_tags, count(*) filter (why = 'bare') as without_tags
    from (select *, case when contains(coalesce(game_id, ''), '7_1') and right(game_id, 3) = '7_1' then 'cut'
      when right(coalesce(game_id, ''), 3) = '3_2' then 'bare' else '' end as why from raw))""",
)
add("a04_player_months", ["players"], f"select {PLAYER_ROW} from players")
add("a05_opening_performance", ["openings"], f"select {OPENING_ROW} from openings")
add("a06_clock_histogram", ["clocks"], "select * from clocks")
add(
    "a07_position_quality", ["scored_buckets"],
    f"select * replace ({r6('avg_cp_loss')} as avg_cp_loss, {r6('blunder_rate')} as blunder_rate) from scored_buckets",
)
add(
    "a08_time_pressure_without_evaluations", ["clocks"],
    "select *, 0::bigint as evaluated_positions, 0::bigint as blunder_count, null::double as avg_cp_loss,"
    " null::double as blunder_rate from clocks",
)
add(
    "a09_player_dimension", ["seats"],
    f"""select md5(player) as player_key, player, min(game_date) as first_seen_date, max(game_date) as last_seen_date,
      count(*) as games_seen, {r6('avg(elo)')} as avg_elo from seats group by player""",
)
add(
    "a10_opening_dimension", ["games"],
    f"""select md5(eco_code || '|' || coalesce(opening_family, '') || '|' || coalesce(opening_variation, '')) as opening_key,
      eco_code, opening_family, opening_variation, count(*) as games_seen, {r6('avg(game_length)')} as avg_game_length
    from games where eco_code is not null group by 2, 3, 4""",
)
add(
    "a11_time_controls", ["games"],
    """select distinct md5(time_control_type || '|' || coalesce(base_time_seconds::varchar, '') || '|'
      || coalesce(increment_seconds::varchar, '')) as time_control_key, time_control_type, base_time_seconds,
      increment_seconds from games where time_control_type is not null""",
)
add(
    "a12_blunder_mart", ["positions"],
    f"select square, count(*) as blunders, {r6('avg(cp_loss)')} as avg_cp_loss from positions where is_blunder group by 1",
)
add(
    "a13_blunder_heatmap", ["positions"],
    f"""select square, count(*) as evaluated_positions, count(*) filter (is_blunder) as blunders,
      {r('avg(cp_loss)', 1)} as avg_cp_loss, max(cp_loss) as max_cp_loss
    from positions where cp_loss is not null and year = 1998 group by 1""",
)
add(
    "a13_heatmap_totals", ["heatmap"],
    "select sum(evaluated_positions)::bigint as evaluated_positions, sum(blunders)::bigint as blunders,"
    " max(max_cp_loss) as max_cp_loss from heatmap",
)
add("a14_opening_stats", ["stats"], f"select * from stats order by {_STAT_ORDER} limit 100")
add(
    "a14_opening_summary_weighted", ["openings"],
    "select eco_code, sum(games_count)::bigint as games_count, "
    + ", ".join(
        f"{r(f'sum({c} * games_count) / sum(games_count)', 4)} as {c}"
        for c in ("white_win_rate", "black_win_rate", "draw_rate", "avg_game_length")
    )
    + " from openings group by 1",
)
add(
    "a15_time_pressure_stats", ["pressure"],
    f"""select time_remaining_bucket, game_phase, time_control_type, sum(games_count)::bigint as games_count,
      sum(evaluated_positions)::bigint as evaluated_positions, sum(blunder_count)::bigint as blunder_count,
      {r('sum(coalesce(avg_cp_loss, 0) * evaluated_positions) / nullif(sum(evaluated_positions), 0)', 1)} as avg_cp_loss,
      {r('sum(blunder_count)::double / nullif(sum(evaluated_positions), 0)', 4)} as blunder_rate
    from pressure where year = 1999 group by 1, 2, 3""",
)
add(
    "a16_player_leaderboard", ["players"],
    f"""select player, sum(games_played)::bigint as games_played, {r('avg(win_rate)', 4)} as avg_win_rate,
      {r('avg(avg_elo)', 1)} as avg_elo, min(most_played_opening_white) as white_opening,
      min(most_played_opening_black) as black_opening
    from players where player ilike '%c1%' group by 1 order by 2 desc, 1 limit 50""",
)
add(
    "a17_overview", ["players", "openings", "clocks", "positions"],
    """select (select count(*) from players) as player_profile_rows, (select count(*) from openings) as opening_rows,
      (select count(*) from clocks) as time_pressure_rows, (select count(cp_loss) from positions) as evaluated_positions,
      (select count(*) from positions where is_blunder) as blunders""",
)
add(
    "a18_table_counts", ["players", "openings", "positions"],
    """select 'opening_stats' as table_name, count(*) as n, 'ready' as status from openings
    union all select 'player_profiles', count(*), 'ready' from players
    union all select 'blunder_positions', count(*), 'ready' from positions""",
)
add(
    "a19_opening_kpis", ["openings"],
    f"""select count(*) as group_count, sum(games_count)::bigint as games, count(distinct eco_code) as codes,
      {r('avg(avg_game_length)', 2)} as avg_length from openings""",
)
add(
    "a19_player_kpis", ["players"],
    f"""select coalesce(sum(games_played), 0)::bigint as games, {r('avg(avg_elo)', 2)} as avg_elo,
      {r('avg(win_rate)', 4)} as win_rate, count(*) as months from players where player = 's5'""",
)
add(
    "a19_heatmap_kpis", ["heatmap"],
    f"""select sum(evaluated_positions)::bigint as evaluated_positions, sum(blunders)::bigint as blunders,
      {r('avg(avg_cp_loss)', 2)} as avg_cp_loss, max(max_cp_loss) as worst_cp_loss from heatmap""",
)
add(
    "a19_time_pressure_kpis", ["pressure_stats"],
    f"""select sum(games_count)::bigint as clock_positions, sum(evaluated_positions)::bigint as evaluated_positions,
      sum(blunder_count)::bigint as blunders, {r('avg(avg_cp_loss)', 2)} as avg_cp_loss,
      {r('sum(blunder_count)::double / nullif(sum(evaluated_positions), 0)', 4)} as blunder_rate
    from pressure_stats where time_control_type in ('blitz', 'rapid')""",
)
_STYLE_R6 = ", ".join(f"{r6(c)} as {c}" for c in STYLE_FLOATS)
add("a20_player_style", ["style"], f"select * replace ({_STYLE_R6}) from style where games_played >= 10")
add(
    "a21_opening_diversity", ["seats"],
    """select player, count(*) as opening_diversity, max(n) as top_opening_games from (select player, eco_code,
      count(*) as n from seats where eco_code is not null group by 1, 2) group by 1""",
)
add("a22_opening_documents", ["openings"], opening_sentences(8, 50))
add("a23_player_documents", ["players"], PLAYER_SENTENCES)
add(
    "a24_class_shares", ["plain"],
    f"select result, count(*) as n, {r6('count(*) / (select count(*) from plain)')} as share from plain group by 1",
)

# ---- windows, sorts, sets

add(
    "w01_player_rating_history", ["seats"],
    f"""select * replace ({r6('win_rate')} as win_rate, {r6('avg_elo')} as avg_elo), {r6('change')} as elo_change
      from (select *, avg_elo - lag(avg_elo) over (partition by player order by year, month) as change from
        (select player, year, month, count(*) as games_played, count(*) filter (won) as wins,
          count(*) filter (lost) as losses, count(*) filter (drew) as draws, avg(won::int) as win_rate,
          avg(elo) as avg_elo from seats group by 1, 2, 3))""".replace("select * replace", "select * exclude (change) replace"),
)
_METRICS = ["silver_count", "white_win", "black_win", "draw", "elo_mean", "elo_stddev"]
_COMPARED = f"""select *, {_PERIOD} as period, {', '.join(f"{_PREV.format(c=c)} as prev_{c}" for c in _METRICS)}
    from {{source}} window t as (order by year, month)"""
add("w02_previous_month", ["months"], _COMPARED.format(source="months"))
tally("w03_evaluation_change", ["positions"], "select ply_number, eval_before_cp, eval_after_cp, cp_loss from positions")
tally("w04_in_check", ["played"], "select ply_number, move, is_in_check from played")
tally("w05_material_balance", ["played"], "select ply_number, move, square, material_balance from played")
add("o01_top_openings", ["stats"], f"select * from stats order by {_STAT_ORDER} limit 25")
_PICK = f"select * exclude (year) from (select {OPENING_ROW} from openings where games_count >= 5 {{where}} order by {{key}} desc, {_STAT_ORDER} limit {{n}})"
add(
    "o02_recommendations_win", ["openings"],
    _PICK.format(where="and elo_bucket = '1400-1600' and time_control_type = 'blitz'", key="openings.white_win_rate", n=10),
)
add("o02_recommendations_draw", ["openings"], _PICK.format(where="", key="openings.draw_rate", n=15))
add("o03_player_history", ["players"], f"select {PLAYER_ROW} from players where player = 's42'")
add("o05_years", ["games"], "select distinct year from games")
add(
    "o06_nearest_vectors", [],
    f"""select * from (select e.vec_id, {r('list_cosine_similarity(e.embedding::double[], q.embedding::double[])', 6)} as similarity
      from embeddings e, (select embedding from embeddings where vec_id = 3) q) order by similarity desc, vec_id limit 6""",
)
add(
    "x01_player_rows", ["seats"],
    """select player, seat, year, count(*) as n, count(*) filter (won) as won, count(*) filter (lost) as lost,
      count(*) filter (drew) as drew, sum(elo)::bigint as elo from seats group by 1, 2, 3""",
)
add(
    "x02_distinct_years", ["raw"],
    "select substr(batch_id, 1, 4) as y from raw union select year(o_orderdate)::varchar from orders",
)

# ---- quality

add(
    "q02_gate_retention", ["bronze", "plain"],
    f"""select b as bronze_count, s as silver_count, {r6('s / b')} as retention
    from (select (select count(*) from bronze) as b, (select count(*) from plain) as s)""",
)
add(
    "q03_gate_checks", ["bronze", "plain"],
    """select position::int as position, name as "check", bad as bad_rows, passed,
      case when passed then '' else printf('only %.2f%% of the bronze rows reached silver, less than 99.00%%', s / b * 100) end as message
    from (select *, case when name = 'retention' then b - s else 0 end as bad,
        case when name = 'retention' then s / b >= 0.99 else true end as passed
      from (select unnest(['bronze_empty', 'silver_empty', 'retention', 'null_game_id', 'null_white', 'null_black',
          'null_result', 'invalid_results', 'bad_elo', 'bad_partitions', 'bad_move_lengths', 'duplicate_game_ids']) as name,
          unnest(range(12)) as position),
        (select (select count(*) from bronze) as b, (select count(*) from plain) as s))""",
)
add(
    "q03_gate_on_candidates", ["raw", "candidates"],
    f"""select (select count(*) from raw) as bronze_count, count(*) as silver_count,
      count(*) filter (game_id is null) as null_game_id, count(*) filter (white is null) as null_white,
      count(*) filter (black is null) as null_black, count(*) filter (result is null) as null_result,
      count(*) filter (result not in ('white_win', 'black_win', 'draw')) as invalid_results,
      count(*) filter (white_elo not between 400 and 3500 or black_elo not between 400 and 3500) as bad_elo,
      count(*) filter (year <> year(game_date) or month <> month(game_date)) as bad_partitions,
      count(*) filter (game_length <> len(moves_san)) as bad_move_lengths,
      count(*) filter (has_clock_data) as clock_rows, count(*) - count(distinct game_id) as duplicate_game_ids,
      {r6('count(*) / (select count(*) from raw)')} as retention,
      {r6('(count(*) filter (has_clock_data)) / count(*)')} as clock_coverage from candidates""",
)
add(
    "q04_gate_metrics", ["plain"],
    f"""select count(*) filter (has_clock_data) as clock_rows,
      {r6('(count(*) filter (has_clock_data)) / count(*)')} as clock_coverage,
      {r6('avg((white_elo::double + black_elo) / 2)')} as elo_mean,
      {r6('stddev_samp((white_elo::double + black_elo) / 2)')} as elo_stddev from plain""",
)
add("q04_result_counts", ["plain"], "select result, count(*) as n from plain group by 1")
add("q04_month_counts", ["plain"], "select year, month, count(*) as n from plain group by 1, 2")
def _moved(name: str) -> str:
    now = f"{name} / greatest(white_win + black_win + draw, 1)"
    was = f"prev_{name} / greatest(prev_white_win + prev_black_win + prev_draw, 1)"
    return f"""select period, 'result_distribution' as "check",
      printf('share of {name} moved by %.1f points, more than 5', round(abs({now} - {was}) * 100, 1)) as message,
      {r(now, 4)} as current, {r(was, 4)} as previous from compared where round(abs({now} - {was}), 12) > 0.05"""


add(
    "q05_drift", ["months"],
    f"""select * from (with compared as ({_COMPARED.format(source='months')})
    select period, 'volume' as "check", printf('volume moved by %.1f%%, more than 20%%',
      round(abs(silver_count - prev_silver_count) / prev_silver_count * 100, 1)) as message,
      silver_count::double as current, prev_silver_count::double as previous from compared
      where round(abs(silver_count - prev_silver_count) / prev_silver_count, 12) > 0.2
    union all {_moved('white_win')} union all {_moved('black_win')} union all {_moved('draw')}
    union all select period, 'elo_distribution', printf('mean rating moved by %.2f deviations, more than 2',
      round(abs(elo_mean - prev_elo_mean) / prev_elo_stddev, 2)), {r('elo_mean', 1)}, {r('prev_elo_mean', 1)}
      from compared where prev_elo_stddev > 0 and round(abs(elo_mean - prev_elo_mean) / prev_elo_stddev, 12) > 2)""",
)
add(
    "q06_expectations", ["raw"],
    """select game_id as value, count(*) as n from raw where game_id is not null group by 1 having count(*) > 1
    union all select result, count(*) from raw where result not in ('1-0', '0-1') group by 1
    union all select eco, count(*) from raw where eco is null group by 1""",
)
add(
    "q07_rating_range_violations", ["bronze"],
    """select * from (select game_id, try_cast(white_elo as integer) as white_elo, try_cast(black_elo as integer) as black_elo
      from bronze) where white_elo not between 400 and 3500 or black_elo not between 400 and 3500""",
)
_MOVED = " + ".join(
    f"(round(abs(n.{c} / (n.white_win + n.black_win + n.draw) - p.{c} / (p.white_win + p.black_win + p.draw)), 12) > 0.05)::int"
    for c in ("white_win", "black_win", "draw")
)
_ANOMALIES = f"""((round(abs(n.silver_count - p.silver_count) / p.silver_count, 12) > 0.2)::int + {_MOVED}
  + coalesce((round(abs(n.elo_mean - p.elo_mean) / p.elo_stddev, 12) > 2)::int, 0))::int"""


def _month(period: str) -> str:
    return f"(select * from months where year = {period[:4]} and month = {int(period[5:])})"


_CARDS = f"""
  select 'parser' as kind, case when g > 0 or p > 0 or r > 0 then 'warn' else 'pass' end as status, seen as primary_count,
    null::double as retention, null::double as clock_coverage, null::bigint as rows_removed, null::bigint as duplicate_game_ids, 0 as anomaly_count
  from (select count(*) as seen, count(*) filter (coalesce(game_id, '') = '') as g, count(*) filter (coalesce(result, '') = '') as r,
    count(*) filter (coalesce(white, '') = '' or coalesce(black, '') = '') as p from raw)
  union all select 'bronze', case when g > 0 or d > 0 then 'warn' else 'pass' end, u, null, null, n - u, d, 0
  from (select count(*) as n, count(*) filter (game_id is null) as g, count(distinct game_id) as u,
    (select count(*) from (select game_id from raw where game_id is not null group by 1 having count(*) > 1)) as d from raw)
  union all select 'silver', 'pass', count(*), null, null, null, null, 0 from plain
  union all select 'quality', case when {_ANOMALIES} > 0 or n.silver_count / b < 0.95 then 'warn' else 'pass' end, n.silver_count,
    {r6('n.silver_count / b')}, {r6('c / n.silver_count')}, null, 0, {_ANOMALIES}
  from {_month('1996-11')} n, {_month('1996-10')} p, (select count(*) as b from bronze where batch_id = '1996-11'),
    (select count(*) filter (has_clock_data) as c from plain where year = 1996 and month = 11)"""
add("q08_diagnostics_cards", ["raw", "bronze", "plain", "months"], _CARDS)
add(
    "q08_cards_summary", ["raw", "bronze", "plain", "months"],
    f"""select count(*) filter (status = 'pass') as pass_count, count(*) filter (status = 'warn') as warn_count,
      sum(anomaly_count)::bigint as anomaly_count from ({_CARDS})""",
)
add(
    "q01_contract", ["plain"],
    """select unnest(['game_id', 'white', 'black', 'result', 'white_elo', 'black_elo', 'game_date', 'year', 'month', 'game_length']) as "column",
      true as named, unnest(['string', 'string', 'string', 'string', 'int', 'int', 'date', 'int', 'int', 'int']) as kind,
      (select count(*) from plain) as rows""",
)
add("q09_class_validation", ["outcomes"], "select result, count(*) as n from outcomes group by 1")

# ---- evaluated positions

tally("e01_half_moves", ["plies"], "select ply_number, move from plies")
tally("e02_target_square", ["moved"], "select move, square from moved")
add(
    "e03_mover_rating", ["played"],
    "select ply_number, count(player_elo) as n, sum(player_elo)::bigint as elo from played group by 1",
)
tally("e04_time_remaining", ["played"], "select ply_number, time_remaining_seconds from played")
add(
    "e05_evaluations", ["positions"],
    "select ply_number, count(before_cp) as n, sum(before_cp)::bigint as before, sum(after_cp)::bigint as after"
    " from positions group by 1",
)
tally("e06_loss_and_blunder", ["positions"], "select cp_loss, is_blunder from positions")
tally("e07_phase", ["played"], "select game_phase, time_control_type from played")
tally(
    "e08_e09_position_features", ["positions"],
    "select game_phase, square, is_in_check, material_balance, is_blunder from positions",
)
add(
    "e10_sampled_positions", ["positions"],
    """select game_id, ply_number, move, square, game_phase, time_control_type, year, player_elo,
      time_remaining_seconds, material_balance, is_in_check, eval_before_cp, eval_after_cp, cp_loss, is_blunder
    from positions where ('0x' || substr(md5('11:' || game_id), 1, 8))::bigint / 4294967296.0::double < 0.02""",
)

# ---- learning

_NUMERIC = [
    "white_elo", "black_elo", "elo_diff", "abs_elo_diff", "base_time_seconds", "increment_seconds", "year", "month",
    "game_length", "has_clock_data", "has_capture", "capture_count", "white_castled", "black_castled",
    "legal_prefix_length",
]
add(
    "m01_blunder_frame", ["positions"],
    """select is_blunder::int as is_blunder, game_phase, time_control_type, count(*) as n,
      sum(player_elo)::double as player_elo, sum(time_remaining_seconds)::double as time_remaining_seconds,
      sum(ply_number)::double as ply_number, sum(material_balance)::double as material_balance,
      sum(is_in_check::int)::bigint as is_in_check, sum(year)::double as year, count(distinct square) as squares
    from positions where is_blunder is not null group by 1, 2, 3""",
)
add(
    "m02_outcome_frame", ["outcomes"],
    "select result, time_control_type, count(*) as n, "
    + ", ".join(f"sum({c}::int)::double as {c}" for c in _NUMERIC)
    + ", count(distinct opening_variation) as variations from outcomes group by 1, 2",
)
add(
    "m03_medians", ["outcomes"],
    " union all ".join(f"select '{c}' as feature, median({c}::int)::double as median from outcomes" for c in _NUMERIC),
)
_LEVELS = ["eco_code", "opening_family", "opening_variation", "time_control_type"]
add(
    "m04_most_frequent_levels", ["outcomes"],
    " union all ".join(
        f"select * from (select '{c}' as feature, {c} as level from outcomes where {c} is not null group by {c}"
        f" order by count(*) desc, {c} limit 1)"
        for c in _LEVELS
    ),
)
tally(
    "m06_rare_levels", ["outcomes"],
    """select case when count(*) over (partition by opening_variation) >= 400 or opening_variation is null
      then opening_variation else '__infrequent__' end as opening_variation, time_control_type from outcomes""",
)
_FILLED = "coalesce({c}, (select {c} from outcomes where {c} is not null group by {c} order by count(*) desc, {c} limit 1), '')"
add(
    "m05_one_hot", ["outcomes"],
    " union all ".join(
        f"select '{c}' as feature, count(distinct {_FILLED.format(c=c)}) as levels,"
        f" (count(distinct {_FILLED.format(c=c)}) + 1)::int as width, count(*) as n, count(*) as ones from outcomes"
        for c in _LEVELS
    ),
)
add(
    "m07_stratified_split", ["outcomes"],
    """select result, is_test, count(*) as n, min(game_id) as first_id, max(game_id) as last_id
    from (select result, game_id, row_number() over (partition by result order by md5('42:' || game_id), game_id)
      <= round(count(*) over (partition by result) * 0.2) as is_test from outcomes) group by 1, 2""",
)
add(
    "m08_class_weights", ["outcomes"],
    f"select result, {r6('(select count(*) from outcomes) / (3 * count(*))')} as weight from outcomes group by 1",
)
add(
    "m08_positive_weight", ["scored"],
    f"""select label, {r6("case when label = 1 then (select count(*) from scored where label = 0) / count(*) else 1 end::double")}
      as weight from scored group by 1""",
)


def _counts(source: str, said: str, yes: str = "label = 1") -> str:
    return f"""select count(*) filter ({yes} and {said}) as tp, count(*) filter (not {yes} and {said}) as fp,
      count(*) filter ({yes} and not {said}) as fn, count(*) filter (not {yes} and not {said}) as tn from {source}"""


_PRECISION, _RECALL = "coalesce(tp / nullif(tp + fp, 0), 0)", "coalesce(tp / nullif(tp + fn, 0), 0)"
_F1 = f"coalesce(2 * {_PRECISION} * {_RECALL} / nullif({_PRECISION} + {_RECALL}, 0), 0)"
_ACCURACY = "(tp + tn) / (tp + fp + fn + tn)"
_FOUR = f"{r6(_ACCURACY)} as accuracy, {r6(_PRECISION)} as precision, {r6(_RECALL)} as recall, {r6(_F1)} as f1"
add("m12_binary_metrics", ["scored"], f"select {_FOUR} from ({_counts('scored', 'score >= 0.5')})")
_ROC = "sum(neg * (pos_upto - pos + pos / 2)) / (sum(pos)::double * sum(neg))"
_AP = "sum(pos * (pos_upto / (pos_upto + neg_upto))) / sum(pos)"
add("m13_ranking_metrics", ["curve"], f"select {r6(_ROC)} as roc_auc, {r6(_AP)} as pr_auc from curve")
add(
    "m13_curve_points", ["curve"],
    "select score, pos, neg, pos_upto::bigint as pos_upto, neg_upto::bigint as neg_upto from curve",
)
add(
    "m14_threshold_sweep", ["scored"],
    f"""select threshold, {r6(_PRECISION)} as precision, {r6(_RECALL)} as recall, {r6(_F1)} as f1
    from (select threshold, count(*) filter (label = 1 and score >= threshold) as tp,
      count(*) filter (label = 0 and score >= threshold) as fp, count(*) filter (label = 1 and score < threshold) as fn
      from scored, (select unnest(range(5, 100, 5)) / 100.0::double as threshold) group by 1)""",
)


def _classwise(source: str, classes: str = "(0), (1), (2)") -> str:
    return f"""select c as class, support, said, hits, coalesce(hits / nullif(said, 0), 0) as precision,
      coalesce(hits / nullif(support, 0), 0) as recall,
      coalesce(2.0::double * hits / nullif(said + support, 0), 0) as f1
    from (select c, count(*) filter (label = c) as support, count(*) filter (prediction = c) as said,
      count(*) filter (label = c and prediction = c) as hits from {source}, (values {classes}) v(c) group by c)
    where support + said > 0"""


def _multi(source: str) -> str:
    clipped = "least(greatest(p[label + 1], 2.220446049250313e-16), 1 - 2.220446049250313e-16)"
    return f"""{r6('sum(hits) / sum(support)')} as accuracy, {r6('avg(case when support > 0 then recall end)')} as balanced_accuracy,
      {r6('avg(f1)')} as macro_f1, {r6('sum(f1 * support) / sum(support)')} as weighted_f1,
      (select {r6(f'-avg(ln({clipped}))')} from {source}) as log_loss from ({_classwise(source)})"""


add("m15_multiclass_metrics", ["classes"], f"select {_multi('classes')}")
add(
    "m16_confusion_matrix", ["classes"],
    "select label, " + ", ".join(f"count(*) filter (prediction = {i}) as predicted_{i}" for i in range(3))
    + " from classes group by 1",
)
add(
    "m16_per_class_f1", ["classes"],
    f"select class, support, {r6('precision')} as precision, {r6('recall')} as recall, {r6('f1')} as f1 from ({_classwise('classes')})",
)


def _baseline(name: str, said: str, score: str) -> str:
    points = f"""select score, pos, neg, sum(pos) over w as pos_upto, sum(neg) over w as neg_upto from (select {score} as score,
      count(*) filter (is_blunder) as pos, count(*) filter (not is_blunder) as neg from labelled group by 1)
      window w as (order by score desc rows unbounded preceding)"""
    return f"""select '{name}' as model, {_FOUR}, (select {r6(_ROC)} from ({points})) as roc_auc,
      (select {r6(_AP)} from ({points})) as pr_auc from ({_counts('labelled', said, 'is_blunder')})"""


_RULE = "(coalesce(time_remaining_seconds, 9999) <= 15 or coalesce(material_balance, 0) < -200)"
add(
    "m17_blunder_baselines", ["positions"],
    f"""select * from (with labelled as (select * from positions where is_blunder is not null)
      {_baseline('majority_class', 'false', '0')}
      union all {_baseline('class_prior_probability', 'false', '0.5')}
      union all {_baseline('low_time_or_material_rule', _RULE, f'{_RULE}::int')})""",
)
add(
    "m18_m25_outcome_baselines", ["outcomes"],
    f"""select * from (with labels as (select case result when 'black_win' then 0 when 'draw' then 1 else 2 end as label,
        white_elo, black_elo from outcomes),
      shares as (select label, count(*) as n, count(*) / sum(count(*)) over () as p from labels group by 1),
      top as (select label as m from shares order by n desc, label limit 1),
      majority as (select label, m as prediction, list_transform([0, 1, 2], lambda i: (i = m)::int::double) as p from labels, top),
      prior as (select label, m as prediction, (select list(p order by label) from shares) as p from labels, top),
      favourite as (select label, prediction, list_transform([0, 1, 2], lambda i: (i = prediction)::int::double) as p
        from (select label, case when white_elo >= black_elo then 2 else 0 end as prediction from labels))
      select 'majority_class' as model, {_multi('majority')}
      union all select 'class_prior_probability', {_multi('prior')}
      union all select 'elo_favorite', {_multi('favourite')})""",
)
add(
    "m19_standardised", ["style"],
    "with s as (select * from style where games_played >= 10) select player, "
    + ", ".join(
        r6(f"({c} - avg({c}) over ()) / coalesce(nullif(stddev_pop({c}) over (), 0), 1)") + f" as {c}_z"
        for c in ("win_rate", "avg_elo", "castle_rate", "opening_diversity")
    )
    + " from s",
)
ORACLE["m19_standardised"] = ORACLE["m19_standardised"].replace(" with s as (", ", s as (", 1)
add(
    "m23_cluster_profiles", ["style"],
    "select (length(player) % 4)::int as cluster, count(*) as cluster_size, "
    + ", ".join(f"{r6(f'avg({c})')} as {c}" for c in STYLE)
    + " from style where games_played >= 10 group by 1",
)
add(
    "m27_knowledge_corpus", ["openings", "players"],
    f"select 'concept_' || item_id as doc_id, text from benchmark union all select * from ({opening_sentences(8)})"
    f" union all select * from ({PLAYER_SENTENCES})",
)
tally(
    "m28_label_index", ["plain"],
    "select result, case result when 'black_win' then 0 when 'draw' then 1 when 'white_win' then 2 end as label from plain",
)

# ---- fitted models: exact facts

_CLASS_ROWS = """select class, n - test_rows as train_rows, n - test_rows as fit_rows, test_rows
  from (select class, count(*) as n, round(count(*) * 0.2::double)::bigint as test_rows from {source} group by 1)"""
_BLUNDERS = "(select *, is_blunder::int as class, game_id || '-' || ply_number as row_id from positions where cp_loss is not null)"
add(
    "m09_blunder_model", ["positions"],
    f"""select *, true as metrics_in_range, true as beats_chance, 250 as trees, 4 as depth
    from ({_CLASS_ROWS.format(source=_BLUNDERS)})""",
)
add(
    "m11_batch_scoring", ["positions"],
    f"""select class as label, count(*) as n, count(*) as n_scored, count(*) as n_called, min(row_id) as first_id, max(row_id) as last_id
    from (select *, row_number() over (partition by class order by md5('42:' || row_id), row_id)
      <= round(count(*) over (partition by class) * 0.2) as is_test from {_BLUNDERS}) where is_test group by 1""",
)
add("m26_o04_importances", [], "select 9::bigint as features, 1.0::double as total, 0::bigint as negative, 0::bigint as unnamed")
_OUTCOME_CLASSES = "(select case result when 'black_win' then 0 when 'draw' then 1 else 2 end as class from outcomes)"
for _name in ("m10_outcome_models", "m10_boosted_outcome_models"):
    add(
        _name, ["outcomes"],
        f"""select *, test_rows as n_sound, test_rows as n_called, true as loss_known
        from ({_CLASS_ROWS.format(source=_OUTCOME_CLASSES)}), (select unnest(['pre_game', 'post_game']) as feature_set)""",
    )
_STYLED = "(select * from style where games_played >= 10)"
add(
    "m20_m22_clustered_players", ["style"],
    f"""select count(*) as players, count(*) as distinct_players, count(*) as placed, 4::bigint as clusters, 4::bigint as labels,
      0::bigint as mixed, count(*) as profiled, true as explained_in_range from {_STYLED}""",
)
add(
    "m21_cluster_sweep", ["style"],
    f"""select k::int as clusters, true as silhouette_in_range, true as inertia_falls
    from (select unnest(range(3, least(8, count(*) - 1) + 1)) as k from {_STYLED})""",
)
_SHAPES = [
    "win_rate", "draw_rate", "avg_elo", "avg_game_length", "avg_capture_count", "capture_game_rate", "opening_diversity",
    "top_opening_share", "bullet_share", "blitz_share",
]
_ZS = ", ".join(
    f"coalesce((m_{c} - avg(m_{c}) over ()) / case when stddev_pop(m_{c}) over () > 0 then stddev_pop(m_{c}) over () else 1 end, 0) as {c}"
    for c in _SHAPES
)
_PERSONA_SUMS = {
    "Bullet Specialists": "bullet_share", "Blitz Specialists": "blitz_share", "Long-Game Grinders": "avg_game_length + draw_rate",
    "Opening Loyalists": "top_opening_share", "Opening Explorers": "opening_diversity - top_opening_share",
    "Sharp Tactical Players": "capture_game_rate + avg_capture_count", "High-Elo Regulars": "avg_elo",
    "Decisive Winners": "win_rate - draw_rate", "Balanced Generalists": "-abs(win_rate) - abs(top_opening_share)",
}
add(
    "m24_persona_scores", ["style"],
    f"""select cluster, rank, persona, {r6('score')} as score from (
      select cluster, unnest([{', '.join(f"{{'rank': {i}, 'persona': '{n}', 'score': ({e})::double}}" for i, (n, e) in enumerate(_PERSONA_SUMS.items()))}], recursive := true)
      from (select cluster, {_ZS} from (select (length(player) % 4)::int as cluster, {', '.join(f'avg({c}) as m_{c}' for c in _SHAPES)}
        from {_STYLED} group by 1)))""",
)

# ---- streams

_KEY = "coalesce(id, game_id)"
tally("t01_t04_published_events", ["event_rows"], f"select {_KEY} as key, 'live' as source, status from event_rows")
add(
    "t02_envelopes", ["event_rows"],
    """select '{"event":{' || coalesce('"game_id":"' || game_id || '",', '') || coalesce('"id":"' || id || '",', '')
      || '"status":"' || status || '","white":"' || white || '"},"ingested_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
      || '+00:00","source":"live"}' as value from event_rows""",
)
tally("t03_event_keys", ["event_rows"], f"select {_KEY} as key from event_rows")
add("t04_capped_publishing", ["event_rows"], "select least(count(*), 500) as n, least(count(*), 500) as envelopes from event_rows")
add("t05_unique_events", ["event_rows"], f"select distinct {_KEY} as key, 'live' as source from event_rows where {_KEY} is not null")
tally(
    "t05_keyless_events", ["event_rows"],
    f"select status, 'null_event_key' as reject_reason from event_rows where {_KEY} is null",
)
_WINDOWS = (
    "select strftime(time_bucket(interval '6 hours', ts), '%Y-%m-%d %H:%M') as window_start, status, count(*) as n_events"
    " from event_rows group by 1, 2"
)
add("t06_status_counts", ["event_rows"], _WINDOWS)
add("t06_status_counts_streamed", ["event_rows"], _WINDOWS)

# ---- surfaces and composites

tally(
    "u02_sql_functions", ["raw"],
    f"""select {RESULT} as result, {TERMINATION} as termination, {REASON} as reason, {rating('white_elo')} as elo,
      {bucket(f'({rating("white_elo")})', f'({rating("black_elo")})')} as bucket,
      len({_SECONDS}) as clocks, array_to_string(bare, ' ') as tokens, array_to_string(san, ' ') as moves,
      case when moves is null then null when length(moves) // 8 <= 10 then 'opening' when length(moves) // 8 <= 30 then 'middlegame'
        else 'endgame' end as phase from ({_SAN})""",
)
tally(
    "u03_partition_scorer", ["plies"],
    "select ply_number as ply, (10 * strpos('abcdefghKQRBN', move[1]) * case when ply_number % 2 = 1 then 1 else -1 end)::int as eval_cp from plies",
)
add(
    "u04_adhoc_select", ["plain"],
    "select result, year, count(*) as n from plain group by 1, 2 order by n desc, result, year",
)
add(
    "c03_gate_and_publish", ["plain", "months"],
    f"""select '1996-10' as period, 'pass' as status, n.silver_count, {_ANOMALIES} as anomalies, '' as failed, n.silver_count as stored_rows
      from {_month('1996-10')} n, {_month('1996-09')} p
    union all select '1996-11', 'pass', n.silver_count, {_ANOMALIES}, '', n.silver_count from {_month('1996-11')} n, {_month('1996-10')} p
    union all select '1996-12', 'fail', n.silver_count, {_ANOMALIES}, 'null_result', 0
      from (select count(*) as silver_count, count(*) filter (result = 'white_win' and white < 'c5') as white_win,
        count(*) filter (result = 'black_win' and white < 'c5') as black_win, count(*) filter (result = 'draw' and white < 'c5') as draw,
        avg((white_elo::double + black_elo) / 2) as elo_mean from plain where year = 1996 and month = 12) n, {_month('1996-11')} p""",
)
add("c04_players_job", ["players"], f"select {PLAYER_ROW} from players")
add("c05_openings_job", ["openings"], f"select {OPENING_ROW} from openings")
add("c06_time_pressure_job", ["pressure"], f"select {PRESSURE_ROW} from pressure")
add(
    "u05_c10_cluster_job", ["style"],
    f"select count(*) as players, count(*) as distinct_players, 4::bigint as clusters from {_STYLED}",
)
add("u05_corpus_job", ["openings", "players"], f"select * from ({opening_sentences(8)}) union all select * from ({PLAYER_SENTENCES})")
ORACLE["u05_coverage_job"] = ORACLE["s14_month_coverage"]
tally(
    "c01_bronze_job", ["raw", "bronze"],
    "select source, 'kept' as state from bronze union all select source, 'rejected' from raw where game_id is null",
)
tally(
    "c02_silver_job", ["plain_candidates"],
    "select result, case when result is not null and year is not null then 'kept' else 'rejected' end as state from plain_candidates",
)
add(
    "c02_silver_games", ["games"],
    "select * replace (array_to_string(clock_seconds, ' ') as clock_seconds, array_to_string(moves_san, ' ') as moves_san) from games",
)
add(
    "c07_evaluated_positions", ["positions"],
    """select game_id, count(*) as n, sum(cp_loss)::bigint as loss, count(*) filter (is_blunder) as blunders,
      sum(material_balance)::bigint as material, max(square) as last_square from positions group by 1""",
)
add(
    "c09_model_tests", [],
    """select unnest(['stg_games.game_id not_null', 'stg_games.game_id unique', 'stg_games.result accepted_values',
      'mart_opening_analysis.eco_code not_null', 'mart_player_profile.player not_null', 'rating range',
      'no null game id']) as test, 0::bigint as failures""",
)
