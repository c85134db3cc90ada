"""SQL that fits models by itself (DuckDB dialect), to check the fitted ones by their figures.

Least squares: the normal equations of standardised columns, solved by Gauss-Jordan elimination in a recursive table. Trees: at each level every
node's best split over all features and bins, by exhaustive search. Neither shares anything with the library's fits.
"""

from __future__ import annotations


def least_squares(rows: str, inputs: list[str], targets: list[str]) -> str:
    """Tables from `rows` (g, inputs, targets), one fit per g: ls_line (g, target, w, base), w in the order of inputs."""
    every, p = [*inputs, *targets], len(inputs)
    means = ", ".join(f"avg({c}) as m_{c}, nullif(stddev_pop({c}), 0) as s_{c}" for c in every)
    scaled = ", ".join([*(f"coalesce(({c} - m_{c}) / s_{c}, 0) as z_{c}" for c in inputs), *(f"{c} - m_{c} as z_{c}" for c in targets)])
    cells = ", ".join(f"{{'i': {i}, 'j': {j}, 'v': sum(z_{a} * z_{b}) / count(*)}}" for i, a in enumerate(inputs, 1) for j, b in enumerate(every, 1) if j >= i)
    weights = ", ".join(f"'{c}'" for c in targets)
    means_in = ", ".join(f"m_{c}" for c in inputs)
    spreads = ", ".join(f"s_{c}" for c in inputs)
    mean_of = " ".join(f"when '{t}' then m_{t}" for t in targets)
    return f"""ls_mean as materialized (select g, {means} from {rows} group by g),
ls_z as materialized (select g, {scaled} from {rows} join ls_mean using (g)),
ls_half as materialized (select g, unnest([{cells}], recursive := true) from ls_z group by g),
ls_full as materialized (select g, i, j, v from ls_half union all select g, j, i, v from ls_half where j > i and j <= {p}),
ls_m as (with recursive step(g, k, i, j, v) as (select g, 1, i, j, v from ls_full union all
  select g, k + 1, i, j, case when head_ < 1e-10 or i = k then v else v - own * theirs / head_ end from (
    select *, max(v) filter (j = k) over (partition by g, i) as own, max(v) filter (i = k) over (partition by g, j) as theirs, max(v) filter (i = k and j = k) over (partition by g) as head_ from step where k <= {p}))
  select g, i, j, v from step where k = {p + 1}),
ls_beta as materialized (select r.g, r.i, r.j - {p} as t, case when d.v < 1e-10 then 0 else r.v / d.v end as b from ls_m r join ls_m d on d.g = r.g and d.i = r.i and d.j = r.i where r.j > {p}),
ls_line as materialized (select g, target, w, (case target {mean_of} end) - list_inner_product(w, [{means_in}]) as base from (
  select g, target, list_transform(list_zip(b, [{spreads}]), lambda z: coalesce(z[1] / z[2], 0)) as w from (select g, list_extract([{weights}], t) as target, list(b order by i) as b from ls_beta group by g, t) join ls_mean using (g)) join ls_mean using (g))"""


def binned(rows: str, inputs: list[str], bins: int) -> str:
    """Tables from `rows` (rid, is_train, inputs): bins (rid, f, b), where b counts the training rows' distinct upper quantiles up to the value."""
    levels = ", ".join(f"{k}::double / {bins}" for k in range(1, bins + 1))
    cells = ", ".join(
        f"{{'f': {k}, 'b': len(list_filter(e_{c}, lambda e: {c} >= e))}}" for k, c in enumerate(inputs)
    )
    seen = ", ".join(f"min({c}) as l_{c}, quantile_cont({c}, [{levels}]) as q_{c}" for c in inputs)
    edges = ", ".join(f"list_filter(list_distinct(list_transform(q_{c}, lambda e: floor(e * 1e6 + 0.5) / 1e6)), lambda e: e > l_{c}) as e_{c}" for c in inputs)
    return f"""seen as materialized (select {seen} from {rows} where is_train),
edges as materialized (select {edges} from seen),
bins as materialized (select rid, unnest([{cells}], recursive := true) from {rows}, edges)"""


def tree(name: str, labels: str, depth: int, leaf: int, gain: float) -> str:
    """Tables of one tree over bins and `labels` (rid, is_train, y): {name}_fit (rid, p) and {name}_splits (f, gain, n)."""
    out = [f"{name}_0 as materialized (select rid, 1::bigint as node from {labels})"]
    for d in range(depth):
        t = f"{name}_{d}"
        out.append(
            f"""{t}_s as materialized (select node, f, b, count(*)::double as n, sum(y)::double as s, sum(y * y)::double as q from {t} join {labels} using (rid) join bins using (rid) where is_train group by node, f, b),
{t}_c as materialized (select *, sum(n) over u as ln, sum(s) over u as ls, sum(q) over u as lq, sum(n) over w as tn, sum(s) over w as ts, sum(q) over w as tq from {t}_s
  window u as (partition by node, f order by b rows unbounded preceding), w as (partition by node, f)),
{t}_g as (select node, f, b, tn, (tq - ts * ts / tn) / tn - ln / tn * ((lq - ls * ls / ln) / ln) - (tn - ln) / tn * (((tq - lq) - (ts - ls) * (ts - ls) / (tn - ln)) / (tn - ln)) as gain
  from {t}_c where ln >= {leaf} and tn - ln >= {leaf}),
{t}_b as materialized (select distinct on (node) node, f, b, tn, gain from {t}_g where gain >= {gain} and gain > 0 order by node, gain desc, f, b),
{name}_{d + 1} as materialized (select t.rid, case when s.node is null then t.node else 2 * t.node + (x.b > s.b)::int end as node from {t} t left join {t}_b s using (node) left join bins x on x.rid = t.rid and x.f = s.f)"""
        )
    last = f"{name}_{depth}"
    out.append(f"{name}_leaf as materialized (select node, sum(y)::double / count(*) as p from {last} join {labels} using (rid) where is_train group by node)")
    out.append(f"{name}_fit as materialized (select rid, p from {last} join {name}_leaf using (node))")
    out.append(f"{name}_splits as ({' union all '.join(f'select f, gain, tn as n from {name}_{d}_b' for d in range(depth))})")
    return ",\n".join(out)
