"""DuckDB SQL that trains boosted trees by their definition, on tables of few distinct values.

A row is (id, f0, f1, label) with small whole numbers as features. Every row of the training table is
drawn anew for each round and model; gradients are rounded row by row and summed per pair of values;
a node is a box of values, and a level cuts each box at its best value. Rounds and levels are
written out one after the other, so the text grows with both.
"""

from __future__ import annotations

from tabkit.operators.boosting import LAMBDA, LEAST_GAIN, LEAST_HESSIAN, SCALE, Settings, mixed

import numpy as np

SEED = 42


def _draws(rounds: int) -> str:
    keys = ", ".join(f"({r}, {int(mixed(np.uint64([(SEED * 65599 + r) & 0xFFFFFFFF]))[0])})" for r in range(1, rounds + 1))
    return f"""
rr as (select * from (values {keys}) t(r, c)),
w0 as (select f0, f1, label, r, xor(u::ubigint, c::ubigint) as x from tr cross join rr),
w1 as (select f0, f1, label, r, (xor(x, x >> 16) * 2246822507::ubigint) % 4294967296::ubigint as x from w0),
w2 as (select f0, f1, label, r, (xor(x, x >> 13) * 3266489909::ubigint) % 4294967296::ubigint as x from w1),
drawn as (select f0, f1, label, r, xor(x, x >> 16) as draw from w2),
cnt as (select m, r, f0, f1, count(*) as n, sum(label)::bigint as p from drawn join ms on draw < sub * 4294967296.0 group by all)"""


def _round(r: int, depth: int) -> str:
    s = f"{float(SCALE)}::double"
    score = f"({{g}}::double / {s} * ({{g}}::double / {s}) / ({{h}}::double / {s} + {LAMBDA}::double))"
    out = [f"""
gh{r} as (select m, f0, f1, ((n - p) * round(q * {SCALE}) + p * round((q - 1) * {SCALE}))::bigint as g,
                 (n * round(greatest(q * (1 - q), {LEAST_HESSIAN}) * {SCALE}))::bigint as h
          from (select cnt.*, 1 / (1 + exp(-mg)) as q from cnt join mg{r - 1} using (m, f0, f1) where r = {r}))""", f"""
b{r}_0 as (select m, -1 as lo0, 1000000 as hi0, -1 as lo1, 1000000 as hi1, 0 as lev from ms)"""]
    for level in range(depth):
        box = "m, lo0, hi0, lo1, hi1"
        out.append(f"""
i{r}_{level} as (select {box}, f0, f1, g, h from b{r}_{level} join gh{r} using (m) where f0 > lo0 and f0 <= hi0 and f1 > lo1 and f1 <= hi1 and lev = {level}),
v{r}_{level} as (select {box}, 0 as k, f0 as v, sum(g)::bigint as g, sum(h)::bigint as h from i{r}_{level} group by all
                union all select {box}, 1, f1, sum(g)::bigint, sum(h)::bigint from i{r}_{level} group by all),
p{r}_{level} as (select {box}, k, v, sum(g) over w as gl, sum(h) over w as hl, sum(g) over a as gt, sum(h) over a as ht from v{r}_{level}
                window w as (partition by {box}, k order by v rows between unbounded preceding and current row), a as (partition by {box}, k)),
q{r}_{level} as (select p.*, {score.format(g="gl", h="hl")} + {score.format(g="(gt - gl)", h="(ht - hl)")} - {score.format(g="gt", h="ht")} as gain
                from p{r}_{level} p join ms using (m) where {level} < depth and hl > 0 and ht - hl > 0 and hl >= ceil(mcw * {SCALE}) and ht - hl >= ceil(mcw * {SCALE})),
c{r}_{level} as (select * from (select *, row_number() over (partition by {box} order by gain desc, k, v) as z from q{r}_{level} where gain > {LEAST_GAIN}) where z = 1),
b{r}_{level + 1} as (
    select b.m, b.lo0, b.hi0, b.lo1, b.hi1, b.lev from b{r}_{level} b left join c{r}_{level} c using ({box}) where c.k is null
    union all select m, lo0, case when k = 0 then v else hi0 end, lo1, case when k = 1 then v else hi1 end, {level + 1} from c{r}_{level}
    union all select m, case when k = 0 then v else lo0 end, hi0, case when k = 1 then v else lo1 end, hi1, {level + 1} from c{r}_{level})""")
    out.append(f"""
l{r} as (select m, lo0, hi0, lo1, hi1, -(sum(g)::double / {s}) / (sum(h)::double / {s} + {LAMBDA}::double) * any_value(lr) as value
         from b{r}_{depth} join gh{r} using (m) join ms using (m) where f0 > lo0 and f0 <= hi0 and f1 > lo1 and f1 <= hi1 group by m, lo0, hi0, lo1, hi1),
mg{r} as (select x.m, x.f0, x.f1, x.mg + l.value as mg from mg{r - 1} x join l{r} l
          on x.m = l.m and x.f0 > lo0 and x.f0 <= hi0 and x.f1 > lo1 and x.f1 <= hi1)""")
    return ",".join(out)


def boosted(settings: list[Settings], rounds: int) -> str:
    """CTEs after ``tr`` (id, u, f0, f1, label) and ``te`` (f0, f1, label): ``mg<r>`` (m, f0, f1, mg) are the
    margins of model m after round r, ``cuts`` (m, r, k, gain) the cuts of feature k."""
    rows = ", ".join(f"({m}, {s.max_depth}, {s.learning_rate}::double, {s.min_child_weight}::double, {s.subsample}::double)" for m, s in enumerate(settings))
    depth = max(s.max_depth for s in settings)
    cuts = " union all ".join(f"select m, {r} as r, k, gain from c{r}_{level}" for r in range(1, rounds + 1) for level in range(depth))
    return f"""
ms as (select * from (values {rows}) t(m, depth, lr, mcw, sub)),
spots as (select f0, f1 from tr union select f0, f1 from te),{_draws(rounds)},
mg0 as (select m, f0, f1, 0::double as mg from ms cross join spots),{",".join(_round(r, depth) for r in range(1, rounds + 1))},
cuts as ({cuts}),
curve as ({" union all ".join(f"select m, {r} as r, f0, f1, mg from mg{r}" for r in range(1, rounds + 1))})"""


#: After ``boosted``: ``sc`` (m, r, value), the area under the ROC curve on ``te`` after each round.
AUC_CTES = """
at_score as (select m, r, mg, sum(label)::bigint as p, sum(1 - label)::bigint as n from curve join te using (f0, f1) group by all),
run as (select *, sum(p) over (partition by m, r order by mg desc) as cp, sum(p) over (partition by m, r) as tp, sum(n) over (partition by m, r) as tn from at_score),
sc as (select m, r, sum(n * (2 * cp - p))::double / 2 / nullif(any_value(tp)::double * any_value(tn)::double, 0) as value from run group by all)"""
#: The same with the mean log-loss.
LOSS_CTES = f"""
sc as (select m, r, (sum(round(case when label = 1 then ln(1 + exp(-mg)) else ln(1 + exp(mg)) end * {SCALE})) / count(*) / {SCALE}) as value
       from curve join te using (f0, f1) group by all)"""


def stops(points: str, patience: int, better: str) -> str:
    """CTEs after ``sc``: ``res`` (combo, best_round, stop_round, value) for the points (combo, m, n) by the
    patience rule; ``better``: ">" or "<"."""
    best = "max" if better == ">" else "min"
    order = "rows between unbounded preceding"
    return f"""
pt as (select * from (values {points}) t(combo, m, n)),
ps as (select combo, r, value from pt join sc using (m) where r <= n),
mk as (select *, {best}(value) over (partition by combo order by r {order} and 1 preceding) as before from ps),
im as (select *, max(case when before is null or value {better} before then r end) over (partition by combo order by r {order} and current row) as best_round from mk),
st as (select combo, coalesce(min(case when r - best_round >= {patience} then r end), max(r)) as stop_round from im group by combo),
res as (select im.combo, im.best_round, st.stop_round, b.value from im join st on im.combo = st.combo and im.r = st.stop_round
        join ps b on b.combo = im.combo and b.r = im.best_round)"""
