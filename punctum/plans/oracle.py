"""The registered queries as DuckDB SQL, written independently of the Spark operators.

Blurs are kernel-table joins over mirrored positions (Spark: windows or arrays), peaks are
anti-joins (Spark: windows), blocks are interval joins (Spark: arithmetic), nearest
neighbours compare all pairs (Spark: a cell pyramid).
"""

from __future__ import annotations

import re

from punctum.params import AXES, BG_MEAN, BG_MEDIAN, BG_NONE, BG_RANSAC_MEAN, SIGMA_RATIO, SpotParams, radius
from punctum.plans.queries import BASE, CROP, MULTI, P2, REACH, SCALARS, SETTINGS

PRIME = 4294967291


def rnd(expr: str, digits: int, name: str) -> str:
    return f"cast(floor(({expr})*1e{digits}+0.5) as bigint)/1e{digits} as {name}"


def cols(axes, prefix="", alias="") -> str:
    return ", ".join(f"{alias}{prefix}{a}" for a in axes)


def on(axes, left: str, right: str) -> str:
    return " and ".join([f"{left}.image={right}.image", *[f"{left}.{a}={right}.{a}" for a in axes]])


def mirror(i: str, n: str) -> str:
    return f"(case when {n}<=1 then 0 else {n}-1-abs(((({i})%greatest(2*({n}-1),1))+2*({n}-1))%greatest(2*({n}-1),1)-({n}-1)) end)"


# --- images ------------------------------------------------------------------------------

EVENTS = """dims as (select max(user_id)+1 nx, max(day(ts)) ny from events),
cells as (select event_type image, user_id x, day(ts)-1 y, sum(cast(round(value*100) as bigint)) v from events group by 1,2,3),
grid as (select image, x, unnest(range(ny)) y, nx, ny from (select image, unnest(range(nx)) x, nx, ny from (select distinct event_type image from events), dims)),
img as (select g.image, g.x, g.y, cast(coalesce(c.v,0) as double) v, g.nx, g.ny from grid g left join cells c on g.image=c.image and g.x=c.x and g.y=c.y)"""

LINES = """dims as (select max(l_suppkey)+1 nx, max(cast(l_quantity as bigint)) ny, max(cast(round(l_discount*100) as bigint))+1 nz from lineitem),
cells as (select l_suppkey x, cast(l_quantity as bigint)-1 y, cast(round(l_discount*100) as bigint) z, count(*) v from lineitem group by 1,2,3),
grid as (select x, y, unnest(range(nz)) z, nx, ny, nz from (select x, unnest(range(ny)) y, nx, ny, nz from (select unnest(range(nx)) x, nx, ny, nz from dims))),
img as (select 'lines' image, g.x, g.y, g.z, cast(coalesce(c.v,0) as double) v, g.nx, g.ny, g.nz from grid g left join cells c on g.x=c.x and g.y=c.y and g.z=c.z)"""

VECTORS = """img as (select 'vectors' image, i-1 x, vec_id y, cast(embedding[i] as double) v,
  (select max(len(embedding)) from embeddings) nx, (select max(vec_id)+1 from embeddings) ny
  from (select vec_id, embedding, unnest(range(1, len(embedding)+1)) i from embeddings))"""

SOURCE = {2: EVENTS, 3: LINES}


def sized(axes, alias="") -> str:
    return ", ".join(f"{alias}n{a}" for a in axes)


def norm_cte(p: SpotParams, axes) -> str:
    if p.auto_range:
        inside = "" if p.crop_min is None else f" where {' and '.join(f'{a} between {l} and {h}' for a, l, h in zip(axes, p.crop_min, p.crop_max))}"
        return (f"lim as (select image, min(v) low, max(v) high from img{inside} group by image), "
                f"nrm as (select i.image, {cols(axes, alias='i.')}, (i.v-l.low)/(l.high-l.low)::double v, {sized(axes, 'i.')} from img i join lim l on i.image=l.image)")
    return f"nrm as (select image, {cols(axes)}, (v-{p.min_intensity!r})/({p.max_intensity!r}-{p.min_intensity!r}) v, {sized(axes)} from img)"


def blur_ctes(source: str, out: str, axes, sigmas) -> list[str]:
    ctes, current = [], source
    for a, s in zip(axes, sigmas):
        r, k, step = radius(s), f"k_{out}_{a}", f"{out}_{a}" if a != axes[-1] else out
        ctes.append(f"{k} as (select o, w/sum(w) over () w from (select o, exp(-(o*o)/(2*{s!r}*{s!r})) w from range(-{r},{r}+1) t(o)))")
        others = "".join(f" and b.{b}=a.{b}" for b in axes if b != a)
        ctes.append(f"at_{step} as (select image, {cols(axes)}, {sized(axes)}, k.w, {mirror(f'{a}+k.o', f'n{a}')} ref from {current} cross join {k} k)")
        ctes.append(
            f"{step} as (select a.image, {cols(axes, alias='a.')}, sum(a.w*b.v) v, {', '.join(f'any_value(a.n{b}) n{b}' for b in axes)} "
            f"from at_{step} a left join {current} b on b.image=a.image{others} and b.{a}=a.ref group by a.image, {cols(axes, alias='a.')})")
        current = step
    return ctes


def dog_ctes(source: str, p: SpotParams, axes, scale="", keep="") -> list[str]:
    n = len(axes)
    return [
        *blur_ctes(source, "ga", axes, p.sigmas(n)), *blur_ctes(source, "gb", axes, p.sigmas(n, wide=True)),
        f"dogs as (select a.image, {cols(axes, alias='a.')}, a.v-b.v dog, {sized(axes, 'a.')} from ga a join gb b on {on(axes, 'a', 'b')})",
    ]


def owner_id(axes, block, alias="", nb=None) -> str:
    idx = [f"(({alias}{a}-1)//{b - 2})" for a, b in zip(axes, block)]
    cnt = [f"cast(ceil(({alias}n{a}-2)/{float(b - 2)!r}) as bigint)" for a, b in zip(axes, block)]
    out = idx[-1]
    for d in range(len(axes) - 2, -1, -1):
        out = f"({idx[d]}+{cnt[d]}*{out})"
    return out


def interior(axes, alias="", p: SpotParams | None = None) -> str:
    if p is not None and p.crop_min is not None:
        return " and ".join(f"{alias}{a} between {l}+1 and {h}-1" for a, l, h in zip(axes, p.crop_min, p.crop_max))
    return " and ".join(f"{alias}{a} between 1 and {alias}n{a}-2" for a in axes)


def neighbour_offsets(axes, r=1, name="offs", zero=False) -> str:
    parts = ", ".join(f"range(-{r},{r}+1) t{a}(d{a})" for a in axes)
    where = "" if zero else " where " + " or ".join(f"d{a}<>0" for a in axes)
    return f"{name} as (select {cols(axes, 'd')} from {parts}{where})"


def peak_ctes(p: SpotParams, axes) -> list[str]:
    same = " and ".join(f"n.{a}=c.p{a}" for a in axes)
    return [
        neighbour_offsets(axes),
        f"cand as (select * from dogs where dog>{p.threshold!r} and {interior(axes, p=p)})",
        f"around as (select c.image, {cols(axes, alias='c.')}, c.dog, {', '.join(f'c.{a}+o.d{a} p{a}' for a in axes)} from cand c cross join offs o)",
        f"beaten as (select distinct c.image, {cols(axes, alias='c.')} from around c join dogs n on n.image=c.image and {same} and n.dog>=c.dog)",
        f"peaks as (select c.* from cand c left join beaten b on {on(axes, 'c', 'b')} where b.image is null)",
    ]


def gradient_ctes(p: SpotParams, axes, source="nrm") -> list[str]:
    joins, values = [], []
    for a in axes:
        for side, step in (("l", "-1"), ("r", "+1")):
            t = side + a
            others = "".join(f" and {t}.{b}=c.{b}" for b in axes if b != a)
            joins.append(f"left join {source} {t} on {t}.image=c.image{others} and {t}.{a}={mirror(f'c.{a}{step}', f'c.n{a}')}")
        values.append(f"(r{a}.v-l{a}.v)/2.0{f'*{p.anisotropy!r}' if a == 'z' else ''} g{a}")
    return [f"grads as (select c.image, {cols(axes, alias='c.')}, {', '.join(values)}, {sized(axes, 'c.')} from {source} c {' '.join(joins)})"]


def region_ctes(p: SpotParams, axes) -> list[str]:
    """Support regions as ``region`` (raw image gradients divided by the range)."""
    r = p.support_radius
    span = "(l.high-l.low)::double" if p.auto_range else f"({p.max_intensity!r}-{p.min_intensity!r})"
    limits = " join lim l on l.image=s.image" if p.auto_range else ""
    at = " and ".join(f"g.{a}=s.p{a}" for a in axes)
    ctes = [
        *gradient_ctes(p, axes, "img"), neighbour_offsets(axes, r, "cube", zero=True),
        f"wanted as (select s.image, {', '.join(f's.{a} s{a}' for a in axes)}, {cols(axes, 'd', 'o.')}, {', '.join(f's.{a}+o.d{a} p{a}' for a in axes)} from peaks s cross join cube o)",
        f"region0 as (select {spot(axes, 's.')}, {cols(axes, 'd', 's.')}, {', '.join(f'g.g{a}/{span} g{a}' for a in axes)} from wanted s join grads g on g.image=s.image and {at}{limits})",
    ]
    if p.background == BG_NONE:
        return ctes + ["region as (select * from region0)"]
    return ctes + background_ctes(p, axes) + [
        f"region as (select r.image, {cols(axes, 's', 'r.')}, {cols(axes, 'd', 'r.')}, {', '.join(f'r.g{a}-b.bg{a} g{a}' for a in axes)} "
        f"from region0 r join bg b on r.image=b.image and {' and '.join(f'r.s{a}=b.s{a}' for a in axes)})"]


def spot(axes, alias="") -> str:
    return f"{alias}image, {cols(axes, 's', alias)}"


def same_spot(axes, a: str, b: str) -> str:
    return f"{a}.image={b}.image and " + " and ".join(f"{a}.s{x}={b}.s{x}" for x in axes)


def background_ctes(p: SpotParams, axes) -> list[str]:
    r = p.support_radius
    shell = f"shell as (select * from region0 where greatest({', '.join(f'abs(d{a})' for a in axes)})={r})"
    if p.background in (BG_MEAN, BG_MEDIAN):
        f = "avg" if p.background == BG_MEAN else "median"
        return [shell, f"bg as (select {spot(axes)}, {', '.join(f'{f}(g{a}) bg{a}' for a in axes)} from shell group by all)"]
    f = "avg" if p.background == BG_RANSAC_MEAN else "median"
    ctes = [shell, "longs as (" + " union all ".join(f"select {spot(axes)}, '{a}' ax, g{a} g from shell" for a in axes) + ")"]
    near = f"abs(v.g-h.g)<={p.background_max_error!r}+1e-9"
    ctes += [
        f"hyp as (select {spot(axes, 'h.')}, h.ax, h.g, count(*) k from (select distinct * from longs) h join longs v on {same_spot(axes, 'h', 'v')} and h.ax=v.ax and {near} group by all)",
        f"best as (select * from hyp qualify row_number() over (partition by {spot(axes)}, ax order by k desc, g)=1)",
        f"sizes as (select {spot(axes)}, ax, count(*) n from longs group by all)",
        f"lvl as (select {spot(axes, 'h.')}, h.ax, case when any_value(h.k)>={p.background_min_inlier_ratio!r}*any_value(s.n) then {f}(v.g) else 0.0 end lev "
        f"from best h join longs v on {same_spot(axes, 'h', 'v')} and h.ax=v.ax and {near} join sizes s on {same_spot(axes, 'h', 's')} and h.ax=s.ax group by {spot(axes, 'h.')}, h.ax)",
        f"bg as (select {spot(axes)}, {', '.join(f'''max(lev) filter (ax='{a}') bg{a}''' for a in axes)} from lvl group by {spot(axes)})",
    ]
    return ctes


def unit_cte(p: SpotParams, axes) -> str:
    """Gradients with a direction: unit vectors u, stretched offsets p, numbered by position."""
    norm = "sqrt(" + "+".join(f"g{a}*g{a}" for a in axes) + ")"
    return (f"units as (select {spot(axes)}, {cols(axes, 'd')}, {', '.join(f'g{a}/nn u{a}' for a in axes)}, "
            f"{', '.join(f'd{a}*{1.0 / p.anisotropy if a == chr(122) else 1.0!r} p{a}' for a in axes)} from (select *, {norm} nn from region) where nn>1e-9)")


def system(axes, u: str, p: str, wrap=lambda e: e):
    """Entries of A and b from unit vectors and positions."""
    m = {}
    for i, a in enumerate(axes):
        for j, b in enumerate(axes):
            if i <= j:
                m[a + b] = m[b + a] = f"({1.0 if a == b else 0.0}-{u}{a}*{u}{b})"
    entries = {k: wrap(e) for k, e in m.items()}
    rhs = {a: wrap("+".join(f"{m[a + b]}*{p}{b}" for b in axes)) for a in axes}
    return entries, rhs


def solved(axes, m: str = "m", r: str = "r"):
    """det and centre from columns mxx, mxy, ..., rx, ry."""
    e = lambda a, b: m + "".join(sorted(a + b))
    if len(axes) == 2:
        det = f"({e('x','x')}*{e('y','y')}-{e('x','y')}*{e('x','y')})"
        return det, [f"({r}x*{e('y','y')}-{e('x','y')}*{r}y)", f"({e('x','x')}*{r}y-{e('x','y')}*{r}x)"]
    xx, xy, xz, yy, yz, zz = (m + k for k in ("xx", "xy", "xz", "yy", "yz", "zz"))
    d3 = lambda a, b, c, d, f, g, h, i, j: f"({a}*({f}*{j}-{g}*{i})-{b}*({d}*{j}-{g}*{h})+{c}*({d}*{i}-{f}*{h}))"
    det = d3(xx, xy, xz, xy, yy, yz, xz, yz, zz)
    return det, [d3(f"{r}x", xy, xz, f"{r}y", yy, yz, f"{r}z", yz, zz), d3(xx, f"{r}x", xz, xy, f"{r}y", yz, xz, f"{r}z", zz), d3(xx, xy, f"{r}x", xy, yy, f"{r}y", xz, yz, f"{r}z")]


def fit_ctes(p: SpotParams, axes, source: str, out: str, inliers="cast(n as bigint)", extra="") -> list[str]:
    """Least squares per spot over ``source`` rows; ``out`` has centres within the support radius."""
    entries, rhs = system(axes, "u", "p", lambda e: f"sum({e})")
    unique = {"".join(sorted(k)): v for k, v in entries.items()}
    det, num = solved(axes)
    stretch = {a: (1.0 / p.anisotropy if a == "z" else 1.0) for a in axes}
    off = ", ".join(f"{n}/det/{stretch[a]!r} o{a}" for n, a in zip(num, axes))
    return [
        f"{out}_s as (select {spot(axes)}, count(*) n, {', '.join(f'{v} m{k}' for k, v in unique.items())}, {', '.join(f'{v} r{a}' for a, v in rhs.items())} from {source} group by {spot(axes)})",
        f"{out}_d as (select *, {det} det from {out}_s)",
        f"{out}_c as (select *, {off} from {out}_d where abs(det)>=1e-9)",
        f"{out} as (select {spot(axes)}, {', '.join(f's{a}+o{a} {a}' for a in axes)}, n from {out}_c)",
    ]


def consensus_ctes(p: SpotParams, axes, source: str, tag: str, k: int) -> list[str]:
    """Inliers of the best hypothesis per spot, as ``inl{tag}`` (rows of ``source``)."""
    seed = lambda c: f"('0x'||substring(h,{8 * c + 1},8))::bigint"
    key = f"md5(concat_ws('|', image, {cols(axes, 's')}, {k}))"
    entries, rhs = {}, {}
    for a in axes:
        for b in axes:
            if a <= b:
                entries[a + b] = f"({2.0 if a == b else 0.0}-i.u{a}*i.u{b}-j.u{a}*j.u{b})"
        line = lambda t: "+".join(f"({1.0 if a == b else 0.0}-{t}.u{a}*{t}.u{b})*{t}.p{b}" for b in axes)
        rhs[a] = f"({line('i')}+{line('j')})"
    det, num = solved(axes)
    diff2 = "+".join(f"(c.c{a}-g.p{a})*(c.c{a}-g.p{a})" for a in axes)
    along = "(" + "+".join(f"(c.c{a}-g.p{a})*g.u{a}" for a in axes) + ")"
    hit = f"{diff2}-{along}*{along}<={p.max_error!r}*{p.max_error!r}+1e-9"
    t = tag
    return [
        f"num{t} as (select *, row_number() over (partition by {spot(axes)} order by {cols(axes, 'd')})-1 rn, count(*) over (partition by {spot(axes)}) n from {source})",
        f"hash{t} as (select *, {seed(0)} s0, {seed(1)} s1, {seed(2)} s2 from (select {spot(axes)}, any_value(n) n, {key} h from num{t} group by {spot(axes)}) where n>=2)",
        f"pair{t} as (select {spot(axes)}, t, (s0+t*s1)%{PRIME}%n i, ((s0+t*s1)%{PRIME}%n+1+(s1+t*s2)%{PRIME}%(n-1))%n j from hash{t}, range({p.hypotheses}) r(t))",
        f"sys{t} as (select {spot(axes, 'q.')}, q.t, {', '.join(f'{v} m{e}' for e, v in entries.items())}, {', '.join(f'{v} r{a}' for a, v in rhs.items())} "
        f"from pair{t} q join num{t} i on {same_spot(axes, 'q', 'i')} and i.rn=q.i join num{t} j on {same_spot(axes, 'q', 'j')} and j.rn=q.j)",
        f"ctr{t} as (select {spot(axes)}, t, {', '.join(f'{n}/det c{a}' for n, a in zip(num, axes))} from (select *, {det} det from sys{t}) where abs(det)>=1e-9)",
        f"cnt{t} as (select {spot(axes, 'c.')}, c.t, any_value(c.cx) cx, {', '.join(f'any_value(c.c{a}) c{a}' for a in axes[1:])}, count(*) k from ctr{t} c join num{t} g on {same_spot(axes, 'c', 'g')} and {hit} group by {spot(axes, 'c.')}, c.t)",
        f"win{t} as (select * from cnt{t} qualify row_number() over (partition by {spot(axes)} order by k desc, t)=1)",
        f"inl{t} as (select g.* exclude (rn), c.k from win{t} c join num{t} g on {same_spot(axes, 'c', 'g')} and {hit})",
    ]


def centre_ctes(p: SpotParams, axes) -> list[str]:
    """``spots`` with centre, gradients, inliers, round from ``region``."""
    ctes = [unit_cte(p, axes), f"total as (select {spot(axes)}, count(*) n from units group by {spot(axes)})"]
    if p.ransac == 0:
        ctes += fit_ctes(p, axes, "units", "fit0")
        return ctes + [f"spots as (select f.*, cast(f.n as bigint) gradients, cast(f.n as bigint) inliers, 0 as round from fit0 f)"]
    if p.ransac == 1:
        ctes += consensus_ctes(p, axes, "units", "0", 0)
        ctes += [f"use0 as (select i.* from inl0 i join total t on {same_spot(axes, 'i', 't')} where i.k>={p.inlier_ratio!r}*t.n)"]
        ctes += fit_ctes(p, axes, "use0", "fit0")
        return ctes + [f"spots as (select f.*, t.n gradients, f.n inliers, 0 as round from fit0 f join total t on {same_spot(axes, 'f', 't')})"]
    source, found = "units", []
    # Every round uses up at least min_inliers gradients, so these rounds exhaust every region.
    for k in range((2 * p.support_radius + 1) ** len(axes) // p.min_inliers):
        ctes += consensus_ctes(p, axes, source, str(k), k)
        ctes += [f"use{k} as (select * from inl{k} where k>={p.min_inliers})"]
        ctes += fit_ctes(p, axes, f"use{k}", f"fit{k}")
        found.append(f"select f.*, t.n gradients, f.n inliers, {k} as round from fit{k} f join total t on {same_spot(axes, 'f', 't')}")
        at = " and ".join(f"r.d{a}=u.d{a}" for a in axes)
        ctes += [f"rest{k} as (select r.* from {source} r join (select distinct {spot(axes)} from use{k}) w on {same_spot(axes, 'r', 'w')} "
                 f"left join use{k} u on {same_spot(axes, 'r', 'u')} and {at} where u.image is null)"]
        source = f"rest{k}"
    return ctes + ["spots_a as (" + " union all ".join(found) + ")"] + weak_ctes("spots_a", "spots", p.n_stdev1, p.n_stdev2)


def weak_ctes(source: str, out: str, n1: float, n2: float) -> list[str]:
    f = "(select image, avg(inliers)-{n!r}*stddev_pop(inliers) lim from {t} group by image)"
    return [
        f"{out}_1 as (select s.* from {source} s join {f.format(n=n1, t=source)} l on s.image=l.image where s.inliers>=l.lim)",
        f"{out} as (select s.* from {out}_1 s join {f.format(n=n2, t=out + '_1')} l on s.image=l.image where s.inliers>=l.lim)",
    ]


def intensity_ctes(axes, least=0.0) -> list[str]:
    bits = ", ".join(f"range(2) t{a}(e{a})" for a in axes)
    weight = "*".join(f"(case when e{a}=1 then s.{a}-floor(s.{a}) else 1-(s.{a}-floor(s.{a})) end)" for a in axes)
    place = ", ".join(f"{mirror(f'cast(floor(s.{a}) as bigint)+e{a}', f'd.n{a}')} q{a}" for a in axes)
    at = " and ".join(f"i.{a}=s.q{a}" for a in axes)
    return [
        f"sdim as (select image, {', '.join(f'max(n{a}) n{a}' for a in axes)} from img group by image)",
        f"corners as (select s.*, {weight} weight, {place} from spots s join sdim d on s.image=d.image cross join (select * from {bits}) e)",
        f"valued as (select {spot(axes, 's.')}, s.round, any_value(s.inliers) inliers, {', '.join(f'any_value(s.{a}) {a}' for a in axes)}, sum(s.weight*i.v) intensity "
        f"from corners s join img i on i.image=s.image and {at} group by {spot(axes, 's.')}, s.round)",
        f"final as (select * from valued where intensity>={least!r})",
    ]


def with_(ctes: list[str], select: str) -> str:
    """Every step is computed once, also where several later steps read it."""
    steps = re.sub(r"^(\w+) as \(", r"\1 as materialized (", ",\n".join(ctes), flags=re.M)
    return "with " + steps + "\n" + select


def until_region(p: SpotParams, n: int) -> list[str]:
    axes = AXES[n]
    return [SOURCE[n], norm_cte(p, axes), *dog_ctes("nrm", p, axes), *peak_ctes(p, axes), *region_ctes(p, axes)]


def localized(n: int, **changes) -> str:
    p, axes = SETTINGS[n].with_(**changes), AXES[n]
    out = ", ".join([spot(axes), "cast(gradients as bigint) gradients", "cast(inliers as bigint) inliers", "cast(round as bigint) as round", *[rnd(a, 4, a) for a in axes]])
    return with_(until_region(p, n) + centre_ctes(p, axes), f"select {out} from spots")


def final_ctes(n: int, least=0.0, **changes) -> list[str]:
    p, axes = SETTINGS[n].with_(**changes), AXES[n]
    return until_region(p, n) + centre_ctes(p, axes) + intensity_ctes(axes, least)


def detected(n: int, least=0.0, keep_inliers=True, **changes) -> str:
    axes = AXES[n]
    out = ", ".join([spot(axes), "cast(inliers as bigint) inliers", *[rnd(a, 4, a) for a in axes], rnd("intensity", 3, "intensity")])
    return with_(final_ctes(n, least, **changes), f"select {out} from final")


def background(n: int, method: int) -> str:
    p, axes = SETTINGS[n].with_(background=method), AXES[n]
    return with_(until_region(p, n), f"select {spot(axes)}, {', '.join(rnd('bg' + a, 7, 'bg' + a) for a in axes)} from bg")


def blocks_ctes(n: int, block, crop=None) -> list[str]:
    axes = AXES[n]
    lo = ["0"] * n if crop is None else [str(c) for c in crop[0]]
    hi = [f"n{a}-1" for a in axes] if crop is None else [str(c) for c in crop[1]]
    ctes = [f"s0 as (select image, {', '.join(f'max(n{a}) n{a}' for a in axes)} from img group by image)"]
    current = "s0"
    for a, l, h, b in zip(axes, lo, hi, block):
        ctes.append(f"s_{a} as (select *, i{a}-1 j{a}, {l}+(i{a}-1)*{b - 2} {a}_min from (select *, unnest(range(1, 1+len(range({l}, {h}-1, {b - 2})))) i{a} from {current}))")
        current = f"s_{a}"
    # Number along the last axis first, so that dimension 0 runs fastest.
    order = ", ".join(f"j{a}" for a in reversed(axes))
    edges = ", ".join(f"{a}_min, least({a}_min+{b - 1}, {h}) {a}_max" for a, b, h in zip(axes, block, hi))
    ctes.append(f"blocks as (select image, row_number() over (partition by image order by {order})-1 block_id, {edges} from {current})")
    return ctes


def in_block(axes, v="v", b="b", pad=0) -> str:
    return f"{v}.image={b}.image and " + " and ".join(f"{v}.{a} between {b}.{a}_min-{pad} and {b}.{a}_max+{pad}" for a in axes)


def split_blocks(n: int, block=None, crop=None) -> str:
    edges = ", ".join(f"{a}_min, {a}_max" for a in AXES[n])
    return with_([SOURCE[n], *blocks_ctes(n, block or SETTINGS[n].block(n), crop)], f"select image, block_id, {edges} from blocks")


def block_voxels(n: int) -> str:
    axes = AXES[n]
    return with_([SOURCE[n], *blocks_ctes(n, SETTINGS[n].block(n))], f"select b.image, b.block_id, {cols(axes, alias='v.')}, v.v from blocks b join img v on {in_block(axes)}")


def block_owner(n: int) -> str:
    axes = AXES[n]
    inner = " and ".join(f"v.{a} between b.{a}_min+1 and b.{a}_max-1" for a in axes)
    return with_([SOURCE[n], *blocks_ctes(n, SETTINGS[n].block(n))], f"select v.image, {cols(axes, alias='v.')}, b.block_id from blocks b join img v on b.image=v.image and {inner}")


def halo_voxels(n: int, pad=2) -> str:
    axes = AXES[n]
    ctes = [SOURCE[n], *blocks_ctes(n, SETTINGS[n].block(n))]
    current = "wide0"
    ctes.append(f"wide0 as (select b.*, {sized(axes, 's.')} from blocks b join s0 s on b.image=s.image)")
    for a in axes:
        ctes.append(f"wide_{a} as (select *, unnest(range({a}_min-{pad}, {a}_max+{pad}+1)) {a} from {current})")
        current = f"wide_{a}"
    at = " and ".join(f"i.{a}={mirror(f'w.{a}', f'w.n{a}')}" for a in axes)
    inside = " and ".join(f"w.{a} between w.{a}_min and w.{a}_max" for a in axes)
    owned = " and ".join(f"w.{a} between w.{a}_min+1 and w.{a}_max-1" for a in axes)
    ext = ", ".join(f"min(w.{a}) min_{a}, max(w.{a}) max_{a}" for a in axes)
    return with_(ctes, f"select w.image, w.block_id, count(*) pixels, sum(i.v) total, count_if({inside})::bigint inside, count_if({owned})::bigint owned, {ext} from {current} w join img i on i.image=w.image and {at} group by all")


def normalize_auto(scope: str) -> str:
    part = "image, block_id" if scope == "block" else "image"
    return with_(
        [EVENTS, *blocks_ctes(2, P2.block(2)), f"bv as (select b.image, b.block_id, v.x, v.y, v.v from blocks b join img v on {in_block(AXES[2])})",
         f"ext as (select *, min(v) over (partition by {part}) lo, max(v) over (partition by {part}) hi from bv)"],
        f"select image, block_id, x, y, {rnd('case when hi=lo then 0.0 else (v-lo)/(hi-lo) end', 8, 'v')} from ext")


def dog_peaks(n: int) -> str:
    p, axes = SETTINGS[n], AXES[n]
    return with_([SOURCE[n], norm_cte(p, axes), *dog_ctes("nrm", p, axes), *peak_ctes(p, axes)],
                 f"select image, {owner_id(axes, p.block(n))} block_id, {cols(axes)}, {rnd('dog', 6, 'dog')} from peaks")


def dog_peaks_auto(scope: str) -> str:
    """The blur is linear and its kernel sums to 1, so a block's DoG is the raw DoG over the block's range."""
    axes, p = AXES[2], P2
    part = "b.image, b.block_id" if scope == "block" else "b.image"
    ext = f"ext as (select distinct b.image, b.block_id, max(v.v) over (partition by {part})-min(v.v) over (partition by {part}) span from blocks b join img v on {in_block(axes)})"
    ctes = [EVENTS, *dog_ctes("img", p, axes), *blocks_ctes(2, p.block(2)), ext,
            f"per_block as (select b.image, b.block_id, d.x, d.y, d.dog/e.span dog, d.x between b.x_min+1 and b.x_max-1 and d.y between b.y_min+1 and b.y_max-1 own "
            f"from blocks b join dogs d on {in_block(axes, 'd')} join ext e on e.image=b.image and e.block_id=b.block_id where e.span>0)",
            neighbour_offsets(axes), f"cand as (select * from per_block where own and dog>{p.threshold!r})",
            "beaten as (select distinct c.image, c.block_id, c.x, c.y from cand c cross join offs o join per_block n on n.image=c.image and n.block_id=c.block_id and n.x=c.x+o.dx and n.y=c.y+o.dy and n.dog>=c.dog)"]
    return with_(ctes, f"select c.image, c.block_id, c.x, c.y, {rnd('c.dog', 6, 'dog')} from cand c left join beaten b on c.image=b.image and c.block_id=b.block_id and c.x=b.x and c.y=b.y where b.image is null")


def spots_csv(n: int, extra="") -> str:
    axes = AXES[n]
    num = ", ".join(f"cast(printf('%.4f', {a}) as double) {a}" for a in (*axes, "intensity"))
    return with_(final_ctes(n, ransac=0), f"select {extra}{num}, 1 t, 1 c from final")


LISTING = """listing as (select concat('data/', source, '/', case when doc_id%5=4 then '' else concat('c', doc_id%4, '_') end,
  'd', doc_id, case when doc_id%3=0 then '.csv' else '.tif' end) key, case when doc_id%7=0 then 0 else n_chars end size from documents)"""

OUT_PATH = f"replace(replace(concat('{BASE}', key), 'data', 'results/data'), '.tif', '.csv')"

TASKS = [LISTING, "numbered as (select *, row_number() over (order by key)-1 rn from listing where contains(key, 'data/') and ends_with(key, '.tif'))"]

SPOT_SETS = """a as (select event_id id, user_id+(event_id%97)/97.0e0 x, day(ts)+(event_id%89)/89.0e0 y from events),
b as (select id, x+(id%7)*0.0023e0 x, y from a where id%11<>0)"""

NEAREST = SPOT_SETS + """,
closest as (select a.id, any_value(a.x) x, any_value(a.y) y, min((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) d2 from a cross join b group by a.id),
best as (select c.id, min(b.id) match_id, sqrt(any_value(c.d2)) distance from closest c cross join b where (c.x-b.x)*(c.x-b.x)+(c.y-b.y)*(c.y-b.y)=c.d2 group by c.id)"""

OPTIONS = """opt as (select doc_id, cast(2+doc_id%2 as int) ndim, doc_id%500+3 p, n_chars q, case when doc_id%2=1 then doc_id%7+3 end r from documents)"""

POLLS = """with bins as (select date_trunc('hour', ts) poll, count(*) n from events group by 1),
grid as (select unnest(generate_series(min(poll), max(poll), interval 1 hour)) poll from bins),
t as (select g.poll, cast(sum(coalesce(n, 0)) over (order by g.poll) as bigint) total from grid g left join bins b on g.poll=b.poll)
select poll, total, case when lag(total) over (order by poll)>0 then total-lag(total) over (order by poll) end processed from t"""


def registry() -> dict[str, str]:
    out: dict[str, str] = {}
    for n, tail in ((2, ""), (3, "_3d")):
        axes, p, src = AXES[n], SETTINGS[n], SOURCE[n]
        lsq = dict(ransac=0)
        out["scan_chunks" + tail] = with_([src], f"select image, {cols(axes)}, v from img")
        out["scan_dataset_meta" + tail] = with_([src], f"select image, {', '.join(f'max({a})+1 n{a}' for a in axes)}, {n} ndim from img group by image")
        out["scan_whole_images" + tail] = with_([src], "select image, count(*) pixels, sum(v) total, min(v) low, max(v) high from img group by image")
        crop = " and ".join(f"{a} between {l} and {h}" for a, l, h in zip(axes, *CROP[n]))
        out["scan_chunk_files" + tail] = out["crop_interval" + tail] = with_([src], f"select image, {cols(axes)}, v from img where {crop}")
        out["split_blocks" + tail] = split_blocks(n)
        out["split_blocks_crop" + tail] = split_blocks(n, (20,) * (n - 1) + (8,), CROP[n])
        out["block_voxels" + tail] = block_voxels(n)
        out["block_owner" + tail] = block_owner(n)
        out["halo_voxels" + tail] = halo_voxels(n)
        out["normalize_fixed" + tail] = with_([src, norm_cte(p, axes)], f"select image, {cols(axes)}, {rnd('v', 8, 'v')} from nrm")
        out["gauss_smooth" + tail] = with_([src, *blur_ctes("img", "g", axes, p.sigmas(n))], f"select image, {cols(axes)}, {rnd('v', 4, 'v')} from g")
        out["dog" if n == 2 else "dog_anisotropic"] = with_([src, norm_cte(p, axes), *dog_ctes("nrm", p, axes)], f"select image, {cols(axes)}, {rnd('dog', 6, 'dog')} from dogs")
        out["dog_peaks" + tail] = dog_peaks(n)
        g = " or ".join(f"g{a}<>0" for a in axes)
        out["gradients" + tail] = with_([src, norm_cte(p, axes), *gradient_ctes(p, axes)], f"select image, {cols(axes)}, {', '.join(rnd('g' + a, 8, 'g' + a) for a in axes)} from grads where {g}")
        out["support_region" + tail] = with_(until_region(p, n), f"select {spot(axes)}, {', '.join(f'cast(d{a} as int) d{a}' for a in axes)}, {', '.join(rnd('g' + a, 8, 'g' + a) for a in axes)} from region")
        for method, name in enumerate(("mean", "median", "ransac_mean", "ransac_median"), 1):
            out[f"background_{name}{tail}"] = background(n, method)
        out["localize_lsq" + tail] = localized(n, **lsq)
        out["localize_ransac" + tail] = localized(n, inlier_ratio=0.0)
        out["ransac_inlier_ratio" + tail] = localized(n, inlier_ratio=0.6 if n == 2 else 0.2)
        out["spot_intensity" + tail] = out["detect_blocks_lsq" + tail] = detected(n, **lsq)
        out["detect_blocks" + tail] = out["detect_images" + tail] = out["detect_in_place" + tail] = detected(n)
        out["write_spots_csv" + tail] = spots_csv(n)
        out["spots_total" + tail] = with_(final_ctes(n, **lsq), "select count(*) spots from final")
        owner = owner_id([f"s{a}" for a in axes], p.block(n)).replace("ns", "n")
        out["spots_per_block" + tail] = with_(
            [*final_ctes(n, **lsq), *blocks_ctes(n, p.block(n)),
             f"per as (select f.image, {owner} block_id, count(*) k from final f join sdim d on f.image=d.image group by 1, 2)"],
            "select b.image, b.block_id, coalesce(p.k, 0) spots from blocks b left join per p on b.image=p.image and b.block_id=p.block_id")
    two = AXES[2]
    out["scan_object_store"] = out["scan_chunks"]
    out["scan_chunks_alt_layout"] = with_([VECTORS], f"select image, x, y, {rnd('v', 6, 'v')} from img")
    out["list_objects"] = "select source, cast(sum(strlen(text)+1) as bigint) size, 0 undated from documents group by source"
    out["scan_chunks_named"] = with_([EVENTS], "select printf('%06d', length(image)*1000+ascii(image)) image, x, y, v from img")
    out["read_dataset_attributes"] = with_([EVENTS], "select image, 2 ndim, max(x)+1 nx, max(y)+1 ny, 64 block_x, 30 block_y, 'uint32' pixel, 'nm' unit, 80.5::double step from img group by image")
    out["write_manifest_single"] = with_(TASKS, f"select 0 chunk, concat('{BASE}', key) input, {OUT_PATH} output from numbered")
    out["udtf_split_blocks_3d"] = out["split_blocks_3d"]
    out["detect_images_auto"] = detected(2, max_intensity=0.0)
    for n, tail in ((2, ""), (3, "_3d")):
        out["detect_images_auto_crop" + tail] = detected(n, max_intensity=0.0, crop_min=CROP[n][0], crop_max=CROP[n][1])
    out["list_by_prefix_ext"] = with_([LISTING], f"select concat('{BASE}', key) uri from listing where contains(key, 'src1') and ends_with(key, '.tif')")
    out["list_summaries"] = with_([LISTING], "select key, size from listing where contains(key, 'src1') and ends_with(key, '.tif')")
    out["list_basenames"] = with_([LISTING], r"select regexp_extract(key, '([^/]+?)(\.[^./]*)?$', 1) as name from listing where contains(key, 'src1')")
    out["input_exists"] = with_([LISTING], "select count(*)>0 as exists from listing where starts_with(key, 'data/src1')")
    out["listing_funnel"] = with_([LISTING], "select count(*) total, count(*) filter (starts_with(key, 'data/src1')) in_prefix, count(*) filter (starts_with(key, 'data/src1') and ends_with(key, '.tif')) with_ext, count(*) filter (starts_with(key, 'data/src1') and ends_with(key, '.tif') and size>0) valid from listing")
    out["nonzero_outputs"] = with_([LISTING], "select key, size from listing where starts_with(key, 'data/src1') and ends_with(key, '.tif') and size>0")
    out["read_accept_list"] = "select concat('d', doc_id, '.tif') as name from labels where quality=1"
    out["read_task_params"] = with_(TASKS, f"select rn//40 chunk, concat('{BASE}', key) input, {OUT_PATH} output from numbered")
    out["task_scalars"] = with_(TASKS, "select distinct rn//40 chunk, pos::int pos, flag, value from numbered, (values (0, '-i0', '4166.0'), (1, '-i1', '46562.0'), (2, '-a', '1.0')) s(pos, flag, value)")
    out["write_manifest"] = with_(TASKS, f"select rn//40 chunk, concat('{SCALARS} ', string_agg(concat('-i {BASE}', key, ' -o ', {OUT_PATH}), ' ' order by rn)) as text from numbered group by 1")
    out["chunk_manifest"] = with_([LISTING, "numbered as (select *, row_number() over (order by key)-1 rn from listing where contains(key, 'data/') and ends_with(key, '.tif'))"], "select key, size, rn, rn//64 chunk from numbered")
    out["zip_inputs_outputs"] = with_([LISTING], "select (row_number() over (order by key)-1)//50 chunk, key input, concat(key, '.out') output from listing")
    out["derive_output_path"] = with_([LISTING], f"select key, {OUT_PATH} output from listing")
    out["uri_parts"] = with_([LISTING], f"select concat('{BASE}', key) uri, 'images' bucket, key object, split_part(key, '/', -1) file, '{BASE}' base from listing")
    tag = "'(^c0_|c1_|c2_|c3_)', ''"
    out["strip_channel_tag"] = with_([LISTING], f"select key, regexp_replace(split_part(key, '/', -1), {tag}) plain, regexp_replace(concat('a_c1_', split_part(key, '/', -1)), {tag}) once from listing")
    out["pending_inputs"] = with_([LISTING], r"select key, size from listing where regexp_extract(key, '([^/]+?)(\.[^./]*)?$', 1) not in (select concat('c', doc_id%4, '_d', doc_id) from documents where doc_id%3<>0 and doc_id%5<2)")
    out["accepted_inputs"] = with_([LISTING], f"select key, size from listing where regexp_replace(split_part(key, '/', -1), {tag}) in (select concat('d', doc_id, '.tif') from labels where quality=1)")
    out["read_spots_csv"] = with_([SPOT_SETS], "select cast(printf('%.4f', x) as double) x, cast(printf('%.4f', y) as double) y, 1 t, 1 c, 1.0::double intensity from a")
    out["format_spot_row"] = with_([SPOT_SETS], "select id, printf('%.4f', x) x, printf('%.4f', y) y, 1 t, 1 c, printf('%.4f', x*3.0e0-y) intensity from a")
    out["sort_spots"] = with_([SPOT_SETS], f"select id, {rnd('x', 6, 'x')}, {rnd('y', 6, 'y')} from a order by 2, 3")
    out["spots_nearest"] = with_([NEAREST], f"select id, match_id, {rnd('distance', 6, 'distance')} from best")
    out["spots_unmatched"] = with_([NEAREST], f"select id, {rnd('distance', 6, 'distance')} from best where distance>=0.01")
    out["write_object_store"] = out["write_spots_csv"]
    out["write_objects_per_image"] = out["write_spots_per_image"] = spots_csv(2, "image, ")
    out["empty_output_guarantee"] = out["write_every_image"] = out["stream_every_image"] = with_(final_ctes(2, 21000.0, ransac=0), "select d.image, count(f.image) spots from sdim d left join final f on d.image=f.image group by 1")
    out["parse_int_list"] = with_([OPTIONS], "select doc_id, ndim arity, p as first, q as second, r as third from opt")
    out["block_size_default"] = with_([OPTIONS], "select doc_id, ndim, case when doc_id%3=0 then concat_ws(',', p, q, r) when ndim=2 then '512,512' else '128,128,64' end size from opt")
    out["intensity_mode"] = "select user_id, strftime(ts, '%Y-%m-%d') as day, case when min(cast(round(value*100) as bigint))=max(cast(round(value*100) as bigint)) then 'auto' else 'fixed' end as mode from events group by 1, 2"
    out["udtf_split_blocks"] = out["split_blocks"]
    out["mirror_extend"] = with_([EVENTS], f"select image, x, y, i, cast({mirror('y+i', 'ny')} as bigint) as at, cast({mirror('x+i', 'nx')} as bigint) along from (select image, x, y, nx, ny, unnest(range(-{REACH}, {REACH}+1)) i from img where least(x, nx-1-x, y, ny-1-y)<{REACH})")
    out["normalize_auto"] = normalize_auto("block")
    out["normalize_auto_image"] = normalize_auto("image")
    out["gauss_smooth_raster"] = with_([VECTORS, *blur_ctes("img", "g", two, (1.5, 1.5))], f"select image, x, y, {rnd('v', 6, 'v')} from g")
    out["dog_raster"] = with_([VECTORS, *dog_ctes("img", P2, two)], f"select image, x, y, {rnd('dog', 6, 'dog')} from dogs")
    out["dog_peaks_auto"] = dog_peaks_auto("block")
    out["dog_peaks_auto_image"] = dog_peaks_auto("image")
    out["localize_lsq_background"] = localized(2, ransac=0, background=BG_MEAN)
    out["localize_multiconsensus"], out["localize_multiconsensus_3d"] = localized(2, **MULTI[2]), localized(3, **MULTI[3])
    out["detect_in_place_crop"] = out["detect_images_auto_crop"]
    out["detect_blocks_multiconsensus"] = detected(2, **MULTI[2])
    p = P2.with_(inlier_ratio=0.0)
    out["multiconsensus_filter"] = with_(until_region(p, 2) + centre_ctes(p, two) + weak_ctes("spots", "kept", 1.5, 1.0), f"select {spot(two)}, cast(inliers as bigint) inliers from kept")
    out["intensity_threshold"] = detected(2, 15000.0, ransac=0)
    out["detect_blocks_background_3d"] = detected(3, ransac=0, background=BG_MEDIAN)
    per_block = [*final_ctes(2, ransac=0), f"placed as (select f.*, {owner_id(['sx', 'sy'], P2.block(2)).replace('ns', 'n')} block_id from final f join sdim d on f.image=d.image)"]
    out["drop_null_results"] = with_(per_block, "select image, block_id, count(*)::int spots from placed group by 1, 2")
    out["merge_blocks"] = with_(per_block, f"select image, block_id, {rnd('x', 4, 'x')}, {rnd('y', 4, 'y')}, {rnd('intensity', 3, 'intensity')} from placed")
    out["spots_per_image"] = with_(final_ctes(2, ransac=0), "select image, count(*) spots from final group by 1")
    out["stream_incremental_detect"] = detected(2, ransac=0)
    out["poll_delta"] = out["stream_output_count"] = POLLS
    out["poll_delta_minute"] = out["stream_output_count_minute"] = POLLS.replace("'hour'", "'minute'").replace("1 hour", "1 minute")
    out["task_durations"] = """with e as (select event_id, cast(round(value*100) as bigint) ms from events)
select concat('t', event_id) task, cast(1 as int) run, event_id*1000 started, case when event_id%10<>0 then event_id*1000+ms end done,
 case when event_id%10<>0 then ms end logged, case when event_id%10<>0 then ms end duration, case when event_id%10<>0 then 'done' else 'open' end status from e
union all select concat('t', event_id), cast(2 as int), event_id*1000+500000000, event_id*1000+500000007, 7, 7, 'done' from e where event_id%15=0"""
    return out
