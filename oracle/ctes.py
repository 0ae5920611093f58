"""The pipeline in ANSI SQL, as named common table expressions.

``with_(names, query)`` puts the needed ones, in order, before a query.
"""

from __future__ import annotations

from plymill.sources.tables import (
    EVALUATED_PLIES,
    UNSCORED,
    EVALUATION_RULES,
    RAW_RULES,
    REFERENCE_FILTER,
    REFERENCE_RULES,
)

SAN = r"(O-O(-O)?|[KQRBN][a-h]?[1-8]?x?[a-h][1-8]|([a-h][1-8]?x)?[a-h][1-8](=?[QRBN])?)[+#]?"


def r6(expression: str) -> str:
    return f"round(round({expression}, 12), 6)"


def r(expression: str, digits: int) -> str:
    return f"round(round({expression}, {digits + 6}), {digits})"


def rules(mapping: dict[str, str]) -> str:
    return ", ".join(f"{rule} as {name}" for name, rule in mapping.items())


def parse_clock(t: str) -> str:
    def whole(i: int) -> str:
        return f"try_cast(string_split({t}, ':')[{i}] as integer)"

    def cut(i: int) -> str:
        return f"try_cast(trunc(try_cast(string_split({t}, ':')[{i}] as double)) as integer)"

    return (
        f"case len(string_split({t}, ':')) when 3 then {whole(1)} * 3600 + {whole(2)} * 60 + {cut(3)}"
        f" when 2 then {whole(1)} * 60 + {cut(2)} when 1 then {cut(1)} end"
    )


def noise(m: str) -> str:
    text = rf"regexp_replace(regexp_replace({m}, '\{{[^}}]*\}}', ' ', 'g'), ';[^\n\r]*', ' ', 'g')"
    for _ in range(4):
        text = rf"regexp_replace({text}, '\([^()]*\)', ' ', 'g')"
    text = rf"regexp_replace(regexp_replace({text}, '\$\d+', ' ', 'g'), '\d+\.(\.\.)?', ' ', 'g')"
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'))"


def clean(t: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace({t}, '^\.+', ''), '[!?]+$', ''), '^[!?]+', '')"


def tokens(m: str) -> str:
    cleaned = f"list_transform(string_split({noise(m)}, ' '), lambda t: {clean('t')})"
    ends = "'', '1-0', '0-1', '1/2-1/2', '*'"
    return f"coalesce(list_filter({cleaned}, lambda t: t not in ({ends})), [])"


def prefix(bare: str) -> str:
    bad = f"coalesce(list_position(list_transform({bare}, lambda t: regexp_full_match(t, '{SAN}')), false), 0)"
    return f"case when {bad} > 0 then {bare}[1:{bad} - 1] else {bare} end"


def rating(t: str) -> str:
    return f"case when try_cast(trim({t}) as integer) between 400 and 3500 then try_cast(trim({t}) as integer) end"


def label(average: str) -> str:
    low = f"(cast(floor({average} / 200.0) as integer) * 200)"
    return f"case when {low} + 200 >= 2200 then '2200+' when {average} is not null then {low} || '-' || ({low} + 200) end"


def bucket(w: str, b: str) -> str:
    average = f"coalesce(cast(floor(({w} + {b}) / 2.0) as integer), {w}, {b})"
    return label(average)


CONTROL = r"""case when lower(time_control) = 'correspondence' then 'correspondence'
  when base + 40 * inc <= 179 then 'bullet' when base + 40 * inc <= 479 then 'blitz'
  when base + 40 * inc <= 1499 then 'rapid' when base + 40 * inc is not null then 'classical' end"""

RESULT = "case result when '1-0' then 'white_win' when '0-1' then 'black_win' when '1/2-1/2' then 'draw' end"
TERMINATION = "replace(lower(trim(termination)), ' ', '_')"
REASON = (
    f"case {TERMINATION} when 'normal' then 'checkmate_or_resignation' when 'time_forfeit' then 'timeout'"
    f" else {TERMINATION} end"
)
PHASE = "case when {ply} <= 20 then 'opening' when {ply} <= 60 then 'middlegame' else 'endgame' end"
TIME_LEFT = (
    "case when {s} <= 5 then '0-5s' when {s} <= 15 then '6-15s' when {s} <= 30 then '16-30s'"
    " when {s} <= 60 then '31-60s' when {s} is not null then '60s+' end"
)

_ORDERED = ", ".join(f"{name} nulls first" for name in RAW_RULES if name != "game_id")


def _games(name: str, reference: bool) -> str:
    family = "coalesce(ref_family, own_family)" if reference else "own_family"
    variation = "coalesce(ref_variation, own_variation)" if reference else "own_variation"
    join = "left join dim on eco_code = ref_code" if reference else ""
    return f"""
        select game_id, white, black, white_elo, black_elo, result, termination, result_reason, eco_code,
          {variation} as opening_variation, {family} as opening_family, time_control_type, base_time_seconds,
          increment_seconds, game_date, cast(len(moves_san) as integer) as game_length,
          len(clock_seconds) > 0 as has_clock_data, clock_seconds,
          len(list_filter(moves_san, lambda m: contains(m, 'x'))) > 0 as has_capture,
          cast(len(list_filter(moves_san, lambda m: contains(m, 'x'))) as integer) as capture_count,
          len(list_filter(moves_san, lambda m, i: m like 'O-O%' and i % 2 = 1)) > 0 as white_castled,
          len(list_filter(moves_san, lambda m, i: m like 'O-O%' and i % 2 = 0)) > 0 as black_castled,
          cast(len(moves_san) as integer) as legal_prefix_length,
          lower(coalesce(white, '')) like '%bot' or lower(coalesce(black, '')) like '%bot' as has_bot_player,
          moves_san, batch_id, cast(year(game_date) as integer) as year, cast(month(game_date) as integer) as month,
          {bucket('white_elo', 'black_elo')} as elo_bucket, had_moves
        from typed {join}"""


_OK = (
    "game_id is not null and white is not null and black is not null and result is not null"
    " and year is not null and month is not null"
)

# name -> (names it reads, query)
CTES: dict[str, tuple[list[str], str]] = {
    "raw": ([], f"select {rules(RAW_RULES)} from lineitem join orders on l_orderkey = o_orderkey"),
    "bronze": (
        ["raw"],
        "select * exclude (rn) from (select *, row_number() over (partition by game_id order by "
        f"{_ORDERED}) as rn from raw where game_id is not null) where rn = 1",
    ),
    "reference": ([], f"select {rules(REFERENCE_RULES)} from part where {REFERENCE_FILTER}"),
    "dim": (
        ["reference"],
        "select eco as ref_code, min(name) as ref_name, split_part(min(name), ':', 1) as ref_family,"
        " case when contains(min(name), ':') then trim(substr(min(name), strpos(min(name), ':') + 1))"
        " else min(name) end as ref_variation from reference where eco is not null group by eco",
    ),
    "prepared": (
        ["bronze"],
        rf"select *, {tokens('moves')} as bare, try_cast(regexp_extract(time_control, '^(\d+)\+(\d+)$', 1) as integer)"
        r" as base, try_cast(regexp_extract(time_control, '^(\d+)\+(\d+)$', 2) as integer) as inc from bronze",
    ),
    "typed": (
        ["prepared"],
        f"""select game_id, white, black, {rating('white_elo')} as white_elo, {rating('black_elo')} as black_elo,
          {RESULT} as result, {TERMINATION} as termination, {REASON} as result_reason, eco as eco_code,
          opening as own_variation, split_part(opening, ':', 1) as own_family, {CONTROL} as time_control_type,
          base as base_time_seconds, inc as increment_seconds,
          try_cast(replace(utc_date, '.', '-') as date) as game_date,
          coalesce(list_filter(list_transform(string_split_regex(trim(clock_annotations), '\\s+'),
            lambda t: {parse_clock('t')}), lambda s: s is not null), []) as clock_seconds,
          {prefix('bare')} as moves_san, batch_id, moves is not null as had_moves from prepared""",
    ),
    "candidates": (["typed", "dim"], _games("candidates", True)),
    "games": (["candidates"], f"select * exclude (had_moves) from candidates where {_OK}"),
    "plain_candidates": (["typed"], _games("plain_candidates", False)),
    "plain": (["plain_candidates"], f"select * exclude (had_moves) from plain_candidates where {_OK}"),
    "staged": (
        ["games"],
        "select game_id, white as white_player, black as black_player, * exclude (game_id, white, black, elo_bucket,"
        " year, month), cast(year(game_date) as integer) as year, cast(month(game_date) as integer) as month from games",
    ),
    "seats": (
        ["plain"],
        """select white as player, 'white' as seat, white_elo as elo, result = 'white_win' as won,
          result = 'black_win' as lost, result = 'draw' as drew, white_castled as castled, * exclude (white, black)
        from plain union all by name
        select black as player, 'black' as seat, black_elo as elo, result = 'black_win' as won,
          result = 'white_win' as lost, result = 'draw' as drew, black_castled as castled, * exclude (white, black)
        from plain""",
    ),
    "favourites": (
        ["seats"],
        """select player, year, month, max(case when seat = 'white' then eco_code end) as w_open,
          max(case when seat = 'black' then eco_code end) as b_open
        from (select player, year, month, seat, eco_code, row_number() over (partition by player, year, month, seat
          order by count(*) desc, eco_code) as rn from seats where eco_code is not null
          group by player, year, month, seat, eco_code)
        where rn = 1 group by player, year, month""",
    ),
    "players": (
        ["seats", "favourites"],
        """select s.player, s.year, s.month, count(*) as games_played, count(*) filter (won) as wins,
          count(*) filter (lost) as losses, count(*) filter (drew) as draws,
          (count(*) filter (won))::double / count(*) as win_rate, avg(elo::double) as avg_elo,
          max(elo) - min(elo) as elo_change, any_value(w_open) as most_played_opening_white,
          any_value(b_open) as most_played_opening_black
        from seats s left join favourites f on s.player = f.player and s.year = f.year and s.month = f.month
        group by s.player, s.year, s.month""",
    ),
    "replies": (
        ["games"],
        """select *, row_number() over (partition by eco_code, opening_family, elo_bucket, time_control_type, year
            order by n desc, reply) as rn
        from (select eco_code, opening_family, elo_bucket, time_control_type, year, moves_san[2] as reply,
          count(*) as n from games where moves_san[2] is not null group by all)""",
    ),
    "openings": (
        ["games", "replies"],
        """select g.eco_code, g.opening_family, g.elo_bucket, g.time_control_type, g.year, count(*) as games_count,
          avg((result = 'white_win')::int) as white_win_rate, avg((result = 'black_win')::int) as black_win_rate,
          avg((result = 'draw')::int) as draw_rate, avg(game_length) as avg_game_length,
          any_value(reply) as most_common_response
        from games g left join (select * from replies where rn = 1) p on g.eco_code is not distinct from p.eco_code
          and g.opening_family is not distinct from p.opening_family
          and g.elo_bucket is not distinct from p.elo_bucket
          and g.time_control_type is not distinct from p.time_control_type and g.year is not distinct from p.year
        group by 1, 2, 3, 4, 5""",
    ),
    "clocks": (
        ["plain"],
        f"""select {TIME_LEFT.format(s='s')} as time_remaining_bucket, {PHASE.format(ply='ply')} as game_phase,
          time_control_type, year, count(*) as games_count
        from (select time_control_type, year, unnest(clock_seconds) as s, generate_subscripts(clock_seconds, 1) as ply
          from plain where has_clock_data) group by 1, 2, 3, 4""",
    ),
    "evals": (
        [],
        f"""select {EVALUATION_RULES['game_id']} as game_id, ply, min({EVALUATION_RULES['eval_cp']}) as eval_cp
        from lineitem, (select unnest(range({EVALUATED_PLIES + 1})) as ply) where not ({UNSCORED}) group by 1, 2""",
    ),
    "plies": (
        ["plain"],
        r"""select game_id, unnest(m) as move, cast(generate_subscripts(m, 1) as integer) as ply_number, clock_seconds,
          time_control_type, year, white_elo, black_elo from (select *, moves_san as m from plain where len(moves_san) > 0)""",
    ),
    "moved": (
        ["plies"],
        r"""select *, case when move like 'O-O-O%' then 'c' || home when move like 'O-O%' then 'g' || home
            else regexp_extract(move, '([a-h][1-8])(=?[QRBN])?[+#]?$', 1) end as square,
          case when move like 'O%' then 'K' when regexp_matches(move, '^[KQRBN]') then move[1]
            when regexp_matches(move, '[1-8]=?[QRBN][+#]?$') then regexp_extract(move, '([QRBN])[+#]?$', 1)
            else 'P' end as piece,
          case when move like 'O-O-O%' then 'd' || home when move like 'O-O%' then 'f' || home end as rook_square,
          lag(regexp_replace(move, '[+#]$', '')) over (partition by game_id order by ply_number) as previous,
          coalesce(regexp_matches(lag(move) over (partition by game_id order by ply_number), '[+#]$'), false) as is_in_check
        from (select *, case when ply_number % 2 = 1 then '1' else '8' end as home from plies)""",
    ),
    "landings": (
        ["moved"],
        """select game_id, ply_number, square, piece from moved
        union all select game_id, ply_number, rook_square, 'R' from moved where rook_square is not null""",
    ),
    "taken": (
        ["moved", "landings"],
        r"""select m.game_id, m.ply_number,
          case when regexp_matches(m.move, '^[a-h]x') and m.square[2] = (case when m.ply_number % 2 = 1 then '6' else '3' end)
              and m.previous = m.square[1] || (case when m.ply_number % 2 = 1 then '5' else '4' end) then 'P'
            when l.piece is not null then l.piece
            when m.square[2] in ('1', '8') then substr('RNBQKBNR', strpos('abcdefgh', m.square[1]), 1)
            else 'P' end as victim
        from (select * from moved where contains(move, 'x')) m asof left join landings l
          on m.game_id = l.game_id and m.square = l.square and m.ply_number > l.ply_number""",
    ),
    "gains": (
        ["moved", "taken"],
        """select m.*, (case victim when 'P' then 100 when 'N' then 320 when 'B' then 330 when 'R' then 500
            when 'Q' then 900 else 0 end)
          + case when regexp_matches(m.move, '^[a-h]') then (case piece when 'N' then 220 when 'B' then 230
            when 'R' then 400 when 'Q' then 800 else 0 end) else 0 end as gain
        from moved m left join taken t on m.game_id = t.game_id and m.ply_number = t.ply_number""",
    ),
    "played": (
        ["gains"],
        f"""select game_id, ply_number, move, square, {PHASE.format(ply='ply_number')} as game_phase, time_control_type,
          year, case when ply_number % 2 = 1 then white_elo else black_elo end as player_elo,
          clock_seconds[ply_number] as time_remaining_seconds,
          cast(coalesce(sum(gain * (case when ply_number % 2 = 1 then 1 else -1 end)) over (partition by game_id
            order by ply_number rows between unbounded preceding and 1 preceding), 0)
            * (case when ply_number % 2 = 1 then 1 else -1 end) as integer) as material_balance, is_in_check
        from gains""",
    ),
    "positions": (
        ["played", "evals"],
        """select *, case when after_cp is null or before_cp is null then null else greatest(0, before_cp - after_cp)
            end as cp_loss, before_cp - after_cp >= 200 as is_blunder,
          before_cp as eval_before_cp, after_cp as eval_after_cp
        from (select p.*, b.eval_cp * (case when ply_number % 2 = 1 then 1 else -1 end) as before_cp,
            a.eval_cp * (case when ply_number % 2 = 1 then 1 else -1 end) as after_cp
          from played p left join evals b on p.game_id = b.game_id and b.ply = p.ply_number - 1
            left join evals a on p.game_id = a.game_id and a.ply = p.ply_number)""",
    ),
    "scored_buckets": (
        ["positions"],
        f"""select {TIME_LEFT.format(s='time_remaining_seconds')} as time_remaining_bucket, game_phase,
          time_control_type, year, count(*) as evaluated_positions, count(*) filter (is_blunder) as blunder_count,
          avg(cp_loss) as avg_cp_loss, (count(*) filter (is_blunder))::double / count(*) as blunder_rate
        from positions where time_remaining_seconds is not null and cp_loss is not null group by 1, 2, 3, 4""",
    ),
    "pressure": (
        ["clocks", "scored_buckets"],
        """select c.*, coalesce(s.evaluated_positions, 0) as evaluated_positions,
          coalesce(s.blunder_count, 0) as blunder_count, s.avg_cp_loss, s.blunder_rate
        from clocks c left join scored_buckets s on c.time_remaining_bucket = s.time_remaining_bucket
          and c.game_phase = s.game_phase and c.time_control_type = s.time_control_type and c.year = s.year""",
    ),
    "pressure_stats": (
        ["pressure"],
        f"""select time_remaining_bucket, game_phase, time_control_type, sum(games_count)::bigint as games_count,
          sum(evaluated_positions)::bigint as evaluated_positions, sum(blunder_count)::bigint as blunder_count,
          {r('sum(coalesce(avg_cp_loss, 0) * evaluated_positions) / nullif(sum(evaluated_positions), 0)', 1)} as avg_cp_loss,
          {r('sum(blunder_count)::double / nullif(sum(evaluated_positions), 0)', 4)} as blunder_rate
        from pressure group by 1, 2, 3""",
    ),
    "heatmap": (
        ["positions"],
        f"""select square, count(*) as evaluated_positions, count(*) filter (is_blunder) as blunders,
          {r('avg(cp_loss)', 1)} as avg_cp_loss, max(cp_loss) as max_cp_loss
        from positions where cp_loss is not null group by 1""",
    ),
    "stats": (
        ["openings"],
        f"""select eco_code, opening_family, elo_bucket, time_control_type, year, sum(games_count)::bigint as games_count,
          {r('avg(white_win_rate)', 4)} as white_win_rate, {r('avg(black_win_rate)', 4)} as black_win_rate,
          {r('avg(draw_rate)', 4)} as draw_rate, {r('avg(avg_game_length)', 1)} as avg_game_length,
          min(most_common_response) as most_common_response
        from openings group by 1, 2, 3, 4, 5""",
    ),
    "months": (
        ["plain"],
        f"""select year, month, count(*) as silver_count, count(*) filter (result = 'white_win') as white_win,
          count(*) filter (result = 'black_win') as black_win, count(*) filter (result = 'draw') as draw,
          {r6('avg((white_elo::double + black_elo) / 2)')} as elo_mean,
          {r6('stddev_samp((white_elo::double + black_elo) / 2)')} as elo_stddev
        from plain group by 1, 2""",
    ),
    "outcomes": (
        ["games"],
        "select *, white_elo - black_elo as elo_diff, abs(white_elo - black_elo) as abs_elo_diff from games"
        " where white_elo is not null and black_elo is not null",
    ),
    "style": (
        ["seats"],
        """select player, count(*) as games_played, avg(won::int) as win_rate, avg(lost::int) as loss_rate,
          avg(drew::int) as draw_rate, avg(elo) as avg_elo, max(elo) - min(elo) as elo_change_proxy,
          avg(game_length) as avg_game_length, avg(capture_count) as avg_capture_count,
          avg(has_capture::int) as capture_game_rate, avg(castled::int) as castle_rate,
          count(distinct eco_code) as opening_diversity, coalesce(any_value(top), 0) / count(*) as top_opening_share,
          avg((coalesce(time_control_type, '') = 'bullet')::int) as bullet_share,
          avg((coalesce(time_control_type, '') = 'blitz')::int) as blitz_share,
          avg((coalesce(time_control_type, '') = 'rapid')::int) as rapid_share,
          avg((coalesce(time_control_type, '') = 'classical')::int) as classical_share,
          avg(has_clock_data::int) as clock_game_rate
        from seats left join (select player as p, max(n) as top from (select player, eco_code, count(*) as n from seats
          where eco_code is not null group by 1, 2) group by 1) on player = p group by player""",
    ),
    "scored": (
        [],
        """select (l_returnflag = 'R')::int as label, ((l_partkey * 7 + l_orderkey * 3
          + case when l_returnflag = 'R' then 90 else 0 end) % 1000) / 1000.0::double as score from lineitem""",
    ),
    "curve": (
        ["scored"],
        """select score, pos, neg, sum(pos) over w as pos_upto, sum(neg) over w as neg_upto from
          (select score, count(*) filter (label = 1) as pos, count(*) filter (label = 0) as neg from scored group by 1)
          window w as (order by score desc rows unbounded preceding)""",
    ),
    "classes": (
        [],
        """select case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as label,
          case when a >= b and a >= c then 0 when b >= c then 1 else 2 end as prediction,
          [a / (a + b + c), b / (a + b + c), c / (a + b + c)] as p
        from (select l_returnflag, (1 + l_partkey % 7)::double as a, (1 + l_suppkey % 5)::double as b,
          (1 + l_linenumber % 6)::double as c from lineitem)""",
    ),
    "event_rows": (
        [],
        """select case when event_id % 11 != 0 then 'e' || event_id % 4000 end as id,
          case when event_id % 7 = 0 then 'x' || event_id end as game_id, 'u' || user_id as white,
          event_type as status, ts from events""",
    ),
}


def with_(names: list[str], query: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in CTES[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    body = ", ".join(f"{name} as ({CTES[name][1]})" for name in ordered)
    return f"with {body} {query}" if body else query
