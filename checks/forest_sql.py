"""Independent SQL of the isolation forest: draws, permutations, growing, scoring, cut-off and permutation importance.

Trees grow level by level (nine levels), and rows walk down by one join per level.
"""

from __future__ import annotations

_P, _SEED, _ROUNDS, _PERMUTATION = 2147483647, 42, 16, 1000003
_S = ["temperature", "humidity", "pressure", "gas_resistance"]


def _draw(*parts: object) -> str:
    """The hash of some numbers: a chain of u -> v*v + v with v = u*48271 + 11, modulo a prime."""
    v = f"((((acc + x) % {_P})*48271 + 11) % {_P})"
    items = ", ".join(f"(({p}) % {_P})::BIGINT" for p in parts)
    return f"list_reduce([0::BIGINT, {items}], lambda acc, x: ({v}*{v} + {v}) % {_P})"


def _keys(stream: str) -> str:
    """Pairing and hash keys of the rounds, as lists."""
    return f"""list(({_draw(_SEED, stream, 'r', 0)}*{_P} + {_draw(_SEED, stream, 'r', 1)}) % n ORDER BY r) AS ks,
      list({_draw(_SEED, stream, 'r', 2)} ORDER BY r) AS cs"""


def _place(position: str) -> str:
    """Swap or not, once per round."""
    other = "((ks[r + 1] - spot + n) % n)"
    high = f"greatest(spot, {other})"
    return f"""list_reduce(list_prepend(({position})::BIGINT, range({_ROUNDS})), lambda spot, r:
      CASE WHEN {_draw('cs[r + 1]', high, f'{high} // {_P}')} % 2 = 1 THEN {other} ELSE spot END)"""


def _length(n: str) -> str:
    return f"CASE WHEN {n} <= 1 THEN 0e0 WHEN {n} = 2 THEN 1e0 ELSE 2e0*(ln({n} - 1e0) + 0.5772156649015329e0) - 2e0*({n} - 1e0)/{n} END"


def forest(prefix: str, source: str) -> dict[str, str]:
    """Tables <prefix>_nodes (tree, heap, depth, f, threshold, n, total) and <prefix>_scale, grown from the rows of ``source``."""
    stats = ", ".join(f"avg({c}) AS m{i}, CASE WHEN stddev_pop({c}) = 0 THEN 1e0 ELSE stddev_pop({c}) END AS s{i}" for i, c in enumerate(_S))
    scaled = ", ".join(f"({c} - m{i})/s{i}" for i, c in enumerate(_S))
    out = {
        f"{prefix}_numbered": f"SELECT event_id, {', '.join(_S)}, row_number() OVER (ORDER BY event_id) - 1 AS rn FROM {source}",
        f"{prefix}_scale": f"SELECT count(*) AS n, {stats} FROM {prefix}_numbered",
        f"{prefix}_keys": f"SELECT tree, n, {_keys('tree')} FROM {prefix}_scale, range(100) AS t(tree), range({_ROUNDS}) AS u(r) GROUP BY tree, n",
        f"{prefix}_drawn": f"SELECT tree, {_place('slot')} AS rn FROM {prefix}_keys, range(256) AS s(slot) WHERE slot < n",
        f"{prefix}_l0": f"SELECT tree, 1::BIGINT AS heap, least(256, n) AS total, [{scaled}] AS x FROM {prefix}_drawn JOIN {prefix}_numbered USING (rn), {prefix}_scale",
    }
    for d in range(9):
        low, high = (", ".join(f"{f}(x[{i}])" for i in range(1, 5)) for f in ("min", "max"))
        out[f"{prefix}_g{d}"] = f"SELECT tree, heap, total, count(*) AS n, [{low}] AS lo, [{high}] AS hi FROM {prefix}_l{d} GROUP BY tree, heap, total"
        out[f"{prefix}_f{d}"] = f"""SELECT *, CASE WHEN {d} < ceil(log2(greatest(2, total))) AND n > 1 AND len(usable) > 0
          THEN usable[1 + {_draw(_SEED, 'tree', 'heap', 0)}*len(usable) // {_P}] END AS f
          FROM (SELECT *, list_filter([1, 2, 3, 4], lambda i: hi[i] > lo[i]) AS usable FROM {prefix}_g{d})"""
        out[f"{prefix}_n{d}"] = f"""SELECT tree, heap, {d} AS depth, f, n, total, CASE WHEN t >= hi[f] THEN lo[f] ELSE t END AS threshold
          FROM (SELECT *, lo[f] + (hi[f] - lo[f])*(({_draw(_SEED, 'tree', 'heap', 1)} + 0.5e0)/{_P}e0) AS t FROM {prefix}_f{d})"""
        if d < 8:
            out[f"{prefix}_l{d + 1}"] = f"""SELECT l.tree, l.heap*2 + CASE WHEN x[f] <= threshold THEN 0 ELSE 1 END AS heap, l.total, x
              FROM {prefix}_l{d} l JOIN {prefix}_n{d} n ON n.tree = l.tree AND n.heap = l.heap WHERE f IS NOT NULL"""
    out[f"{prefix}_nodes"] = " UNION ALL ".join(f"SELECT * FROM {prefix}_n{d}" for d in range(9))
    return out


def scores(name: str, prefix: str, source: str) -> dict[str, str]:
    """Table <name> (of the columns of ``source`` but x, and score): rows (..., x) of ``source`` walked down the trees of ``prefix``."""
    out = {f"{name}_w0": f"SELECT s.* EXCLUDE (x), tree, 1::BIGINT AS heap, x FROM {source} s, range(100) AS t(tree)"}
    for d in range(8):
        out[f"{name}_w{d + 1}"] = f"""SELECT w.* EXCLUDE (heap, x), CASE WHEN f IS NULL THEN w.heap WHEN x[f] <= threshold THEN 2*w.heap ELSE 2*w.heap + 1 END AS heap, x
          FROM {name}_w{d} w JOIN {prefix}_nodes n ON n.tree = w.tree AND n.heap = w.heap"""
    out[name] = f"""SELECT * EXCLUDE (mean, total), round(-pow(2e0, -mean/({_length('total')})), 12) AS score FROM (
      SELECT w.* EXCLUDE (tree, heap, x), avg(depth + {_length('n')}) AS mean, max(total) AS total
      FROM {name}_w8 w JOIN {prefix}_nodes n ON n.tree = w.tree AND n.heap = w.heap GROUP BY ALL)"""
    return out


def _scaled(rows: str, prefix: str) -> str:
    x = ", ".join(f"({c} - m{i})/s{i}" for i, c in enumerate(_S))
    return f"SELECT event_id, [{x}] AS x FROM {rows}, {prefix}_scale"


_VARIANT = "CASE WHEN v = 0 THEN p.x ELSE list_transform(range(1, 5), lambda i: CASE WHEN i = v THEN q.x[i] ELSE p.x[i] END) END"

CTES = {
    **forest("plain", "readings"),
    **forest("trained", "labelled"),
    "train_x": _scaled("labelled", "trained"),
    **scores("train_scores", "trained", "train_x"),
    "train_cut": """SELECT s[1 + floor(h)::INT] + (s[1 + ceil(h)::INT] - s[1 + floor(h)::INT])*(h - floor(h)) AS cut FROM (
      SELECT list(score ORDER BY score) AS s, (count(*) - 1)*(SELECT least(0.5e0, greatest(0.01e0, avg(is_anomaly))) FROM labelled) AS h FROM train_scores)""",
    "reading_x": _scaled("readings", "trained"),
    **scores("reading_scores", "trained", "reading_x"),
    "mixed_x": "SELECT r.event_id, row_number() OVER (ORDER BY r.event_id) - 1 AS rn, x FROM reading_x r",
    "mixed_keys": f"SELECT n, {_keys(str(_PERMUTATION))} FROM (SELECT count(*) AS n FROM mixed_x), range({_ROUNDS}) AS u(r) GROUP BY n",
    "mixed_to": f"SELECT event_id, x, {_place('rn')} AS other FROM mixed_x, mixed_keys",
    "variants": f"SELECT p.event_id, v, {_VARIANT} AS x FROM mixed_to p JOIN mixed_x q ON q.rn = p.other, range(5) AS t(v)",
    **scores("variant_scores", "trained", "variants"),
}

_NODE = "row_number() OVER (PARTITION BY tree ORDER BY bin(heap)) - 1"

BODIES = {
    "fit_forest": f"""SELECT n.tree, n.node::INTEGER AS node, coalesce(n.f - 1, -1)::INTEGER AS feature, round(CASE WHEN n.f IS NULL THEN 0e0 ELSE n.threshold END, 6) AS threshold,
      CASE WHEN n.f IS NULL THEN -1 ELSE n.node + 1 END::INTEGER AS left, coalesce(r.node, -1)::INTEGER AS right,
      round(CASE WHEN n.f IS NULL THEN n.depth + {_length('n.n')} ELSE 0e0 END, 6) AS path, n.total::INTEGER AS sample_size
      FROM (SELECT *, {_NODE} AS node FROM plain_nodes) n LEFT JOIN (SELECT tree, heap, {_NODE} AS node FROM plain_nodes) r ON r.tree = n.tree AND r.heap = 2*n.heap + 1 AND n.f IS NOT NULL""",
    "forest_score": """SELECT event_id, round(score, 6) AS anomaly_score, CASE WHEN score < cut THEN -1 ELSE 1 END AS prediction, (score < cut)::INTEGER AS is_anomaly
      FROM reading_scores, train_cut""",
    "permutation_importance": """SELECT feature, round(avg(abs(v.score - b.score)), 4) AS importance FROM variant_scores v
      JOIN variant_scores b ON b.event_id = v.event_id AND b.v = 0
      JOIN (SELECT unnest([1, 2, 3, 4]) AS v, unnest(['temperature', 'humidity', 'pressure', 'gas_resistance']) AS feature) f ON f.v = v.v GROUP BY feature""",
}
