"""DuckDB text of the lexicon sentiment rules, written token-per-row with
window look-backs (an independent formulation of the in-row Spark
expressions)."""

from __future__ import annotations

from inkwell.config import lexicon as LX
from inkwell.functions.sentiment import EDGE_PUNCT_RE, PUNCT_CHARS, idiom_words
from inkwell.functions.text import WHITESPACE_CLASS
from inkwell.plans.oracles import q


def _values(rows) -> str:
    return ", ".join(f"({q(k)}, {float(v)!r})" for k, v in rows)


BOOST_CTE = ("boost_(term, b) AS (VALUES "
             + _values([(w, LX.B_INCR) for w in LX.BOOSTERS_UP] + [(w, LX.B_DECR) for w in LX.BOOSTERS_DOWN])
             + ")")
NEG_LIST = ", ".join(q(w) for w in LX.NEGATIONS)
SENT_SPLIT = (f"list_filter(string_split(regexp_replace({{t}}, {q('([.!?])' + WHITESPACE_CLASS + '+')}, "
              f"'\\1' || chr(1), 'g'), chr(1)), lambda s: length(trim(s)) > 0)")


def split_sql(text: str) -> str:
    return SENT_SPLIT.replace("{t}", text)


def _step(acc: str, d: int) -> str:
    s0 = f"coalesce(p{d}b, 0.0)"
    s1 = f"(CASE WHEN {acc} < 0 THEN -{s0} ELSE {s0} END)"
    s2 = (f"(CASE WHEN {s0} <> 0 AND p{d}up AND cap_diff THEN (CASE WHEN {acc} > 0 THEN {s1} + {LX.C_INCR} "
          f"ELSE {s1} - {LX.C_INCR} END) ELSE {s1} END)")
    damp = LX.DAMPING[d]
    if d == 1:
        factor = f"(CASE WHEN p1neg THEN {LX.N_SCALAR} ELSE 1.0 END)"
    elif d == 2:
        factor = (f"(CASE WHEN p2w = 'never' AND p1w IN ('so', 'this') THEN 1.25 "
                  f"WHEN p2w = 'without' AND p1w = 'doubt' THEN 1.0 "
                  f"WHEN p2neg THEN {LX.N_SCALAR} ELSE 1.0 END)")
    else:
        factor = (f"(CASE WHEN p3w = 'never' AND (p2w IN ('so', 'this') OR p1w IN ('so', 'this')) THEN 1.25 "
                  f"WHEN p3w = 'without' AND (p2w = 'doubt' OR p1w = 'doubt') THEN 1.0 "
                  f"WHEN p3neg THEN {LX.N_SCALAR} ELSE 1.0 END)")
    return (f"(CASE WHEN i >= {d} AND p{d}val IS NULL THEN ({acc} + {s2} * {damp}) * {factor} "
            f"ELSE {acc} END)")


def vader_ctes(src: str, keys: list[str], lexicon: dict[str, float] | None = None) -> str:
    """CTEs turning relation ``src`` (columns: keys, ``stext``) into
    ``vader_out(keys..., compound)``; one output row per input row.  A lexicon
    term with a blank is an idiom, one with edge punctuation an emoticon."""
    lexicon = lexicon or LX.DEFAULT_LEXICON | LX.EMOTICONS | LX.IDIOMS
    idioms = {" ".join(idiom_words(t)): v for t, v in lexicon.items() if " " in t}
    words = {t: v for t, v in lexicon.items() if " " not in t}
    emoticons = ", ".join(q(t) for t in sorted(words) if t.strip(PUNCT_CHARS) != t)
    longest = max(len(t.split()) for t in idioms)
    idiom_rows = ", ".join(f"(string_split({q(t)}, ' '))" for t in sorted(idioms))
    k = ", ".join(keys)
    part = ", ".join(keys)
    least_in_lex = "least" in words
    lags = ", ".join(
        f"lag(w, {d}) OVER po AS p{d}w, lag(val, {d}) OVER po AS p{d}val, lag(bst, {d}) OVER po AS p{d}b, "
        f"lag(up, {d}) OVER po AS p{d}up, lag(neg, {d}) OVER po AS p{d}neg" for d in (1, 2, 3))
    least = ("1.0" if least_in_lex else
             f"(CASE WHEN p1w = 'least' THEN (CASE WHEN i > 1 THEN (CASE WHEN NOT coalesce(p2w IN ('at', 'very'), false) "
             f"THEN {LX.N_SCALAR} ELSE 1.0 END) ELSE {LX.N_SCALAR} END) ELSE 1.0 END)")
    return f""",
lex_(term, valence) AS (VALUES {_values(sorted((words | idioms).items()))}),
{BOOST_CTE},
idiom_(words) AS (VALUES {idiom_rows}),
vs_ AS (SELECT {k}, stext, list_filter(string_split_regex(stext, {q(WHITESPACE_CLASS + '+')}),
          lambda t: length(t) > 1) AS toks FROM {src}),
vt_ AS (SELECT {k}, unnest(toks) AS raw, generate_subscripts(toks, 1) - 1 AS i FROM vs_),
vr_ AS (SELECT {k}, i, CASE WHEN lower(raw) IN ({emoticons}) THEN lower(raw)
          ELSE lower(regexp_replace(raw, {q(EDGE_PUNCT_RE)}, '', 'g')) END AS w,
          (upper(raw) = raw AND lower(raw) <> raw) AS up FROM vt_),
-- the longest idiom at a token, then the leftmost of those that overlap
vx_ AS (SELECT *, list(w) OVER (PARTITION BY {part} ORDER BY i ROWS BETWEEN CURRENT ROW AND {longest - 1} FOLLOWING)
          AS ahead, list(up) OVER (PARTITION BY {part} ORDER BY i ROWS BETWEEN CURRENT ROW AND {longest - 1} FOLLOWING)
          AS ups FROM vr_),
vm_ AS (SELECT {k}, i, any_value(ups) AS ups, max(len(words)) AS m FROM vx_ JOIN idiom_
        ON ahead[1] = words[1] AND ahead[1:len(words)] = words GROUP BY {k}, i),
vg_ AS (SELECT {k}, list_reduce(list({{'from': i, 'till': i + m, 'kept': [i]}} ORDER BY i), lambda a, b:
          CASE WHEN b['from'] >= a['till'] THEN {{'from': b['from'], 'till': b['till'],
          'kept': list_concat(a['kept'], b['kept'])}} ELSE a END)['kept'] AS kept FROM vm_ GROUP BY {k}),
vk_ AS (SELECT {k}, i, i + m AS till, list_bool_and(ups[1:m]) AS up FROM vm_ JOIN (SELECT {k}, unnest(kept) AS i FROM vg_)
        USING ({k}, i)),
vi_ AS (SELECT vx_.*, max(vk_.till) OVER po AS till, max(CASE WHEN vk_.i IS NOT NULL THEN vk_.i END) OVER po AS start,
          vk_.up AS idiom_up FROM vx_ LEFT JOIN vk_ USING ({k}, i) WINDOW po AS (PARTITION BY {part} ORDER BY i)),
vw_ AS (SELECT {k}, row_number() OVER (PARTITION BY {part} ORDER BY i) - 1 AS i,
          count(*) OVER (PARTITION BY {part}) AS n,
          CASE WHEN i = start THEN list_aggregate(ahead[1:till - i], 'string_agg', ' ') ELSE w END AS w,
          CASE WHEN i = start THEN idiom_up ELSE up END AS up
        FROM vi_ WHERE till IS NULL OR i >= till OR i = start),
vl_ AS (SELECT vw_.*, lex_.valence AS val, boost_.b AS bst,
          (w IN ({NEG_LIST}) OR contains(w, 'n''t')) AS neg
        FROM vw_ LEFT JOIN lex_ ON lex_.term = vw_.w LEFT JOIN boost_ ON boost_.term = vw_.w),
vc_ AS (SELECT *, (count(*) FILTER (WHERE up) OVER ps) AS n_caps,
          min(CASE WHEN w = 'but' THEN i END) OVER ps AS but_pos,
          lead(w, 1) OVER po AS n1w, {lags}
        FROM vl_ WINDOW ps AS (PARTITION BY {part}), po AS (PARTITION BY {part} ORDER BY i)),
vd_ AS (SELECT *, n_caps > 0 AND n_caps < n AS cap_diff FROM vc_),
v1_ AS (SELECT *, CASE WHEN up AND cap_diff THEN (CASE WHEN val > 0 THEN val + {LX.C_INCR} ELSE val - {LX.C_INCR} END)
          ELSE val END AS a0 FROM vd_),
v2_ AS (SELECT *, {_step('a0', 1)} AS a1 FROM v1_),
v3_ AS (SELECT *, {_step('a1', 2)} AS a2 FROM v2_),
v4_ AS (SELECT *, {_step('a2', 3)} AS a3 FROM v3_),
v5_ AS (SELECT {k}, CASE WHEN val IS NULL OR bst IS NOT NULL OR (w = 'kind' AND coalesce(n1w = 'of', false))
          THEN 0.0 ELSE a3 * {least} * (CASE WHEN but_pos IS NULL THEN 1.0 WHEN i < but_pos THEN 0.5
          WHEN i > but_pos THEN 1.5 ELSE 1.0 END) END AS sc FROM v4_),
v6_ AS (SELECT {k}, sum(sc) AS total FROM v5_ GROUP BY {k}),
v7_ AS (SELECT s.*, coalesce(v6_.total, 0.0) AS total,
          least(length(s.stext) - length(replace(s.stext, '!', '')), 4) * {LX.EXCLAIM_WEIGHT} AS ep,
          length(s.stext) - length(replace(s.stext, '?', '')) AS qm
        FROM {src} s LEFT JOIN v6_ USING ({k})),
v8_ AS (SELECT *, ep + CASE WHEN qm > 1 THEN (CASE WHEN qm <= 3 THEN qm * {LX.QUESTION_WEIGHT} ELSE {LX.QUESTION_CAP} END)
          ELSE 0.0 END AS punct FROM v7_),
v9_ AS (SELECT *, CASE WHEN total > 0 THEN total + punct WHEN total < 0 THEN total - punct ELSE total END AS s2
        FROM v8_),
vader_out AS (SELECT {k}, round(greatest(-1.0, least(1.0, s2 / sqrt(s2 * s2 + {LX.NORM_ALPHA}))), 4) AS compound
              FROM v9_)"""


LABEL_SQL = ("CASE WHEN {s} > 0.1 AND {s} < 0.5 THEN 'mildy_positive' WHEN {s} >= 0.5 THEN 'positive' "
             "WHEN {s} < -0.1 AND {s} > -0.5 THEN 'mildy_negative' WHEN {s} <= -0.5 THEN 'negative' "
             "ELSE 'neutral' END")


def label_sql(score: str) -> str:
    return LABEL_SQL.replace("{s}", score)
