"""The registered queries in DuckDB's SQL, stated independently of the Spark code.

Floats are rounded to six digits; ``+ 0.0`` turns a negative zero positive.
"""

from __future__ import annotations


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


def unnested(source: str, keep: str, values: str, into: str = "value") -> str:
    """One row per list element, with its 0-based position."""
    return (
        f"SELECT {keep}, i AS idx, {r6(f'({values})[i + 1]::DOUBLE')} AS {into} FROM "
        f"(SELECT *, unnest(range(len({values}))) AS i FROM {source})"
    )


#: Units in the hidden layers of the network and of the autoencoder.
H, CODE = 256, 32

X = "list_transform(embedding, lambda v: v::DOUBLE)"
STATS = (
    "stats AS (SELECT count(v) n, avg(v) m, stddev_pop(v) s "
    "FROM (SELECT unnest(embedding)::DOUBLE v FROM embeddings))"
)
Z = (
    f"{STATS}, z AS (SELECT vec_id AS id, label + 1 AS label1, "
    "list_transform(embedding, lambda v: (v::DOUBLE - m) / s) AS features "
    "FROM embeddings, stats)"
)


# --- formula weights: by row, column and ordinal of the parameter ---------------


#: (ordinal, step): the parameter that is moved along its direction, see ``_slopes``.
_moved: list[tuple[int, float]] = []


def cell(row: str, col: str, t: int) -> str:
    value = f"((({row}) * 31 + ({col}) * 17 + {t * 13}) % 11 - 5) / 10::DOUBLE"
    for ordinal, step in _moved:
        if ordinal == t:
            value = f"({value} + ((({row}) * 7 + ({col}) * 5) % 3 - 1) * ({step}::DOUBLE))"
    return value


def matrix(rows: int, cols: int, t: int) -> str:
    inner = f"list_transform(range({cols}), lambda wc: {cell('wr', 'wc', t)})"
    return f"list_transform(range({rows}), lambda wr: {inner})"


def vector(n: int, t: int) -> str:
    return f"list_transform(range({n}), lambda wc: {cell('0', 'wc', t)})"


def affine(x: str, n_out: int, w: str, b: str) -> str:
    return (
        f"list_transform(range({n_out}), "
        f"lambda k: list_dot_product({w}[k + 1], {x}) + {b}[k + 1])"
    )


def mapped(x: str, body: str) -> str:
    return f"list_transform({x}, lambda v: {body})"


RELU, TANH, SIGMOID = "greatest(v, 0::DOUBLE)", "tanh(v)", "1 / (1 + exp(-v))"


def log_softmax(x: str) -> str:
    total = f"ln(list_sum(list_transform({x}, lambda u: exp(u - list_max({x})))))"
    return f"list_transform({x}, lambda v: v - list_max({x}) - {total})"


LINEAR = (
    f"w AS (SELECT {matrix(10, 64, 0)} AS w0, {vector(10, 1)} AS b0), "
    f"raw AS (SELECT vec_id, label + 1 AS label1, {X} AS x FROM embeddings), "
    f"logits AS (SELECT vec_id, label1, {affine('x', 10, 'w0', 'b0')} AS s FROM raw, w), "
    f"scored AS (SELECT vec_id, label1, s, {log_softmax('s')} AS scores FROM logits)"
)


def best(scores: str) -> str:
    """0-based best class, equal to nine digits counting as equal."""
    near = f"list_transform({scores}, lambda v: round(v, 9))"
    return f"list_position({near}, list_max({near})) - 1"


TOP5 = (
    "SELECT vec_id, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class_id) AS rank, "
    "class_id, score FROM (SELECT vec_id, i AS class_id, {scores}[i + 1]::DOUBLE AS score FROM "
    "(SELECT *, unnest(range(len({scores}))) AS i FROM {source})) QUALIFY rank <= 5"
)


# --- models ---------------------------------------------------------------------


Forward = tuple[str, str]


def _forward(weights: str, *steps: tuple[str, str]) -> Forward:
    """Chain of ``name = expression`` columns over the raw samples, and the last name."""
    sql = (
        f"WITH w AS (SELECT {weights}), "
        f"t0 AS (SELECT vec_id, label + 1 AS label1, {X} AS x FROM embeddings)"
    )
    for n, (name, expr) in enumerate(steps):
        # only the newest column is carried on, besides the input
        sql += f", t{n + 1} AS (SELECT vec_id, label1, x, {expr} AS {name} FROM t{n}, w)"
    return f"{sql}, out AS (SELECT vec_id, label1, {steps[-1][0]} AS y FROM t{len(steps)})", "y"


def _scores(forward: Forward) -> str:
    sql, y = forward
    return f"{sql} {unnested('out', 'vec_id', y, 'score')}"


def _mean_loss(forward: Forward, logits: bool) -> str:
    sql, y = forward
    log_probs = log_softmax(y) if logits else y
    return f"{sql} SELECT avg(-({log_probs})[label1]) AS loss FROM out"


def _slopes(forward, params: list[tuple[str, str]], logits: bool, step: float = 1e-6) -> str:
    """Central difference of the mean loss along one direction per parameter."""
    rows = []
    for t, (layer, param) in enumerate(params):
        sides = []
        for signed in (step, -step):
            _moved.append((t, signed))
            sides.append(_mean_loss(forward(), logits))
            _moved.pop()
        rows.append(
            f"SELECT '{layer}' AS layer, '{param}' AS param, "
            f"round((({sides[0]}) - ({sides[1]})) / {2 * step}::DOUBLE, 3) + 0.0 AS slope"
        )
    return " UNION ALL ".join(rows)


def _mlp() -> Forward:
    weights = ", ".join(
        f"{matrix(o, i, 2 * n)} AS w{n}, {vector(o, 2 * n + 1)} AS b{n}"
        for n, (i, o) in enumerate(((64, H), (H, H), (H, 10)))
    )
    return _forward(
        weights,
        ("h1", mapped(affine("x", H, "w0", "b0"), RELU)),
        ("h2", mapped(affine("h1", H, "w1", "b1"), RELU)),
        ("z", affine("h2", 10, "w2", "b2")),
        ("y", log_softmax("z")),
    )


def _autoencoder() -> Forward:
    weights = (
        f"{matrix(CODE, 64, 0)} AS w0, {vector(CODE, 1)} AS b0, "
        f"{matrix(64, CODE, 2)} AS w1, {vector(64, 3)} AS b1"
    )
    return _forward(
        weights,
        ("h", mapped(affine("x", CODE, "w0", "b0"), RELU)),
        ("y", mapped(affine("h", 64, "w1", "b1"), SIGMOID)),
    )


def _conv(x: str, c_in: int, c_out: int, k: int, side: int, t: int) -> str:
    """Valid convolution of c_in maps; weight index ((o * c_in + c) * k + row) * k + col."""
    out = side - k + 1
    o, y, z = f"(i // {out * out})", f"((i // {out}) % {out})", f"(i % {out})"
    c, r, q = f"(p // {k * k})", f"((p // {k}) % {k})", f"(p % {k})"
    weight = cell(f"({o} * {c_in} + {c}) * {k} + {r}", q, t)
    source = f"{x}[{c} * {side * side} + ({y} + {r}) * {side} + {z} + {q} + 1]"
    total = f"list_sum(list_transform(range({c_in * k * k}), lambda p: {weight} * {source}))"
    bias = cell("0", o, t + 1)
    return f"list_transform(range({c_out * out * out}), lambda i: {total} + {bias})"


def _pool(x: str, channels: int, side: int) -> str:
    half = side // 2
    at = (
        f"(i // {half * half}) * {side * side} + ((i // {half}) % {half}) * {2 * side} "
        f"+ (i % {half}) * 2 + 1"
    )
    four = ", ".join(f"{x}[{at} + {d}]" for d in (0, 1, side, side + 1))
    return f"list_transform(range({channels * half * half}), lambda i: greatest({four}))"


def _lenet() -> Forward:
    weights = (
        f"{matrix(20, 12, 4)} AS w2, {vector(20, 5)} AS b2, "
        f"{matrix(10, 20, 6)} AS w3, {vector(10, 7)} AS b3"
    )
    return _forward(
        weights,
        ("c1", mapped(_conv("x", 1, 6, 3, 8, 0), TANH)),
        ("p1", mapped(_pool("c1", 6, 6), TANH)),
        ("c2", _conv("p1", 6, 12, 2, 3, 2)),
        ("p2", _pool("c2", 12, 2)),
        ("h", mapped(affine("p2", 20, "w2", "b2"), TANH)),
        ("z", affine("h", 10, "w3", "b3")),
        ("y", log_softmax("z")),
    )


STEPS = "list_transform(range(8), lambda t: list_slice(x, t * 8 + 1, t * 8 + 8))"


def _gate(k: str, h: str, w: str) -> str:
    return (
        f"(list_dot_product(wi{w}[{k} + 1], xt) + list_dot_product(wh{w}[{k} + 1], {h}) "
        f"+ b{w}[{k} + 1])"
    )


def _sig(z: str) -> str:
    return f"(1 / (1 + exp(-{z})))"


def _rnn() -> Forward:
    weights = (
        f"{matrix(8, 8, 0)} AS wi, {matrix(8, 8, 1)} AS wh, {vector(8, 2)} AS b, "
        f"{matrix(10, 8, 3)} AS w1, {vector(10, 4)} AS b1, "
        "list_transform(range(8), lambda q: 0::DOUBLE) AS zero"
    )
    step = f"list_transform(range(8), lambda k: tanh({_gate('k', 'h', '')}))"
    return _forward(
        weights,
        ("h", f"list_reduce({STEPS}, lambda h, xt: {step}, zero)"),
        ("y", affine("h", 10, "w1", "b1")),
    )


def _lstm_step(w: str, h: str, c) -> str:
    """New state of an 8-unit LSTM as one list: 8 outputs, then 8 cells."""
    k = "(k % 8)"
    i, f, g, o = (_gate(f"({k} + {8 * n})", h, w) for n in range(4))
    cell_ = f"({_sig(f)} * {c(k)} + {_sig(i)} * tanh({g}))"
    return (
        f"list_transform(range(16), lambda k: CASE WHEN k < 8 "
        f"THEN {_sig(o)} * tanh({cell_}) ELSE {cell_} END)"
    )


def _lstm_weights(t: int, w: str = "") -> str:
    return (
        f"{matrix(32, 8, t)} AS wi{w}, {matrix(32, 8, t + 1)} AS wh{w}, {vector(32, t + 2)} AS b{w}"
    )


_LSTM_LAST = (
    f"list_reduce({STEPS}, lambda st, xt: "
    + _lstm_step("", "list_slice(st, 1, 8)", lambda k: f"st[{k} + 9]")
    + ", zero)"
)


def _lstm() -> Forward:
    weights = (
        f"{_lstm_weights(0)}, {matrix(10, 8, 3)} AS w1, {vector(10, 4)} AS b1, "
        "list_transform(range(16), lambda q: 0::DOUBLE) AS zero"
    )
    return _forward(
        weights, ("st", _LSTM_LAST), ("y", affine("list_slice(st, 1, 8)", 10, "w1", "b1"))
    )


def _birnn() -> Forward:
    """At the last step the backward half has seen the last input only."""
    weights = (
        f"{_lstm_weights(0)}, {_lstm_weights(3, '_bw')}, "
        f"{matrix(10, 16, 6)} AS w1, {vector(10, 7)} AS b1, "
        "list_transform(range(16), lambda q: 0::DOUBLE) AS zero"
    )
    backward = _lstm_step("_bw", "list_slice(zero, 1, 8)", lambda k: f"zero[{k} + 9]")
    backward = f"list_reduce([list_slice(x, 57, 64)], lambda st, xt: {backward}, zero)"
    both = f"list_concat(list_slice({_LSTM_LAST}, 1, 8), list_slice({backward}, 1, 8))"
    return _forward(weights, ("h", both), ("y", affine("h", 10, "w1", "b1")))


# --- pixels ---------------------------------------------------------------------

GREY = "list_transform(embedding, lambda v: floor(abs(v::DOUBLE) * 1000)::BIGINT % 256)"
RGB = (
    f"grey AS (SELECT vec_id, label, {GREY} AS g FROM embeddings), "
    "rgb AS (SELECT vec_id, label, list_transform(range(192), lambda i: "
    "(g[i // 3 + 1] * ((i % 3) * 2 + 1) + (i % 3) * 31) % 256) AS p FROM grey)"
)
BGR = "list_transform(p, lambda v, i: p[i + 2 - ((i - 1) % 3) * 2])"
U8 = "list_transform(p, lambda v: ((v & 255) / 255::DOUBLE)::FLOAT)"
MEANS, STDS = "[0.485, 0.456, 0.406]::DOUBLE[]", "[0.229, 0.224, 0.225]::DOUBLE[]"


def draw(key: str, seed: int, epoch: int) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {key}, {seed}, {epoch})), 1, 8))::BIGINT"


def pixels(*steps: str, keep: str = "vec_id") -> str:
    """Chain of expressions over ``p``; every step replaces it."""
    sql = f"WITH {RGB}, q0 AS (SELECT vec_id, label + 1 AS label1, p FROM rgb)"
    for n, step in enumerate(steps):
        sql += f", q{n + 1} AS (SELECT vec_id, label1, {step} AS p FROM q{n})"
    return f"{sql} {unnested(f'q{len(steps)}', keep, 'p')}"


def crop(side: int, out_h: int, out_w: int, top: str, left: str) -> str:
    return (
        f"list_transform(range({out_h * out_w * 3}), lambda i: "
        f"p[((i // {out_w * 3} + {top}) * {side} + (i // 3) % {out_w} + {left}) * 3 + i % 3 + 1])"
    )


def random_crop(side: int, out_h: int, out_w: int, seed: int, epoch: int) -> str:
    d, nl, nt = draw("vec_id", seed, epoch), side - out_w + 1, side - out_h + 1
    return crop(side, out_h, out_w, f"(({d}) // {nl}) % {nt}", f"({d}) % {nl}")


def random_flip(side: int, seed: int, epoch: int) -> str:
    mirrored = (
        f"list_transform(range({side * side * 3}), lambda i: "
        f"p[((i // {side * 3}) * {side} + {side - 1} - (i // 3) % {side}) * 3 + i % 3 + 1])"
    )
    return f"CASE WHEN {draw('vec_id', seed, epoch)} < 2147483648 THEN {mirrored} ELSE p END"


NORMALIZED = (
    f"list_transform(p, lambda v, i: ((v::DOUBLE - ({MEANS})[(i - 1) % 3 + 1]) "
    f"/ ({STDS})[(i - 1) % 3 + 1])::FLOAT)"
)


def chw(side: int) -> str:
    plane = side * side
    return (
        f"list_transform(range({plane * 3}), "
        f"lambda i: p[(i % {plane}) * 3 + i // {plane} + 1])"
    )


def bilinear(out: int) -> str:
    """8 x 8 x 3 to out x out x 3, half-pixel centres, rounded half up."""

    def centre(at: str) -> str:
        return f"least(greatest(({at} + 0.5::DOUBLE) * 8 / {out} - 0.5::DOUBLE, 0::DOUBLE), 7::DOUBLE)"

    y, x, c = f"(i // {out * 3})", f"((i // 3) % {out})", "(i % 3)"
    y0, x0 = f"floor({centre(y)})::BIGINT", f"floor({centre(x)})::BIGINT"
    fy, fx = f"({centre(y)} - {y0})", f"({centre(x)} - {x0})"

    def tap(dy: int, dx: int) -> str:
        return f"p[(least({y0} + {dy}, 7) * 8 + least({x0} + {dx}, 7)) * 3 + {c} + 1]"

    left = f"({tap(0, 0)} * (1 - {fy}) + {tap(1, 0)} * {fy})"
    right = f"({tap(0, 1)} * (1 - {fy}) + {tap(1, 1)} * {fy})"
    value = f"floor({left} * (1 - {fx}) + {right} * {fx} + 0.5::DOUBLE)::BIGINT"
    return f"list_transform(range({out * out * 3}), lambda i: {value})"


def _picture(scale: str) -> str:
    """Small pictures, their scores under formula weights (times ``scale``), log-softmaxed."""
    return (
        f"WITH {RGB}, small AS (SELECT vec_id, {bilinear(6)} AS p FROM rgb), "
        f"w AS (SELECT {matrix(10, 108, 0)} AS w0, {vector(10, 1)} AS b0), "
        "inputs AS (SELECT vec_id, list_transform(p, lambda v: "
        + ("(v / 127.5::DOUBLE - 1)::FLOAT::DOUBLE" if scale == "pm1" else "v::DOUBLE")
        + ") AS x FROM small), "
        f"raw AS (SELECT vec_id, {affine('x', 10, 'w0', 'b0')} AS s0 FROM inputs, w), "
        "logits AS (SELECT vec_id, list_transform(s0, lambda v: v"
        + (" / 255" if scale == "255" else "")
        + f") AS s FROM raw), scored AS (SELECT vec_id, {log_softmax('s')} AS scores FROM logits)"
    )


# --- parameter tables -----------------------------------------------------------

CENTROIDS = (
    "means AS (SELECT label, i AS idx, avg(embedding[i + 1]::DOUBLE) AS v FROM "
    "(SELECT label, embedding, unnest(range(64)) AS i FROM embeddings) GROUP BY ALL), "
    "half AS (SELECT label, -sum(v * v) / 2 AS b FROM means GROUP BY label), "
    "params AS (SELECT 'score' AS layer, 'weight' AS param, label AS block, label * 64 + idx AS idx, v FROM means "
    "UNION ALL SELECT 'score', 'bias', 0, label, b FROM half), "
    "scales AS (SELECT layer, param, block, max(abs(v)) / 127 AS scale FROM params GROUP BY ALL), "
    "q AS (SELECT layer, param, block, idx, scale, v, "
    "CASE WHEN scale = 0 THEN 0 ELSE round(v / scale)::INT END AS q "
    "FROM params JOIN scales USING (layer, param, block))"
)
QUANTIZED = (
    f"WITH {CENTROIDS}, flat AS (SELECT vec_id, label, i, embedding[i + 1]::DOUBLE AS x FROM "
    "(SELECT *, unnest(range(64)) AS i FROM embeddings)), "
    "logits AS (SELECT vec_id, wt.block AS k, sum(x * wt.v) AS full_, sum(x * wt.q * wt.scale) AS small_ "
    "FROM flat JOIN (SELECT * FROM q WHERE param = 'weight') wt ON wt.idx - wt.block * 64 = flat.i "
    "GROUP BY vec_id, wt.block), "
    "biased AS (SELECT vec_id, k, round(full_ + b.v, 9) AS f, round(small_ + b.q * b.scale, 9) AS s "
    "FROM logits JOIN (SELECT * FROM q WHERE param = 'bias') b ON b.idx = k), "
    "preds AS (SELECT vec_id, arg_min(k, (-f, k)) AS pred, arg_min(k, (-s, k)) AS pred_q "
    "FROM biased GROUP BY vec_id)"
)

# --- training -------------------------------------------------------------------

CLASS_ROWS = "(SELECT unnest(range(10)) AS k)"
GRAD_ZERO = f"""
WITH flat AS (
  SELECT label, i AS j, embedding[i + 1]::DOUBLE AS x
  FROM (SELECT *, unnest(range(64)) AS i FROM embeddings)),
weight AS (
  SELECT 'weight' AS param, k * 64 + j AS idx,
         avg((0.1::DOUBLE - CASE WHEN label = k THEN 1 ELSE 0 END) * x) AS v
  FROM flat, {CLASS_ROWS} GROUP BY k, j),
bias AS (
  SELECT 'bias' AS param, k AS idx,
         avg(0.1::DOUBLE - CASE WHEN label = k THEN 1 ELSE 0 END) AS v
  FROM embeddings, {CLASS_ROWS} GROUP BY k)
SELECT 'score' AS layer, param, idx, {r6('v')} AS value
FROM (SELECT * FROM weight UNION ALL SELECT * FROM bias)
"""


def _sync_steps() -> str:
    """Two full-batch steps of rate 0.2 from zero; input 64 is the constant of the bias."""
    return f"""
WITH {Z}, flat AS (
  SELECT id, label1 - 1 AS y, i AS j, CASE WHEN i = 64 THEN 1::DOUBLE ELSE features[i + 1] END AS x
  FROM (SELECT *, unnest(range(65)) AS i FROM z)),
w1 AS (
  SELECT k, j, -0.2::DOUBLE * avg((0.1::DOUBLE - CASE WHEN y = k THEN 1 ELSE 0 END) * x) AS w
  FROM flat, {CLASS_ROWS} GROUP BY k, j),
logits AS (
  SELECT id, any_value(y) AS y, k, sum(x * w) AS s FROM flat JOIN w1 USING (j) GROUP BY id, k),
probs AS (
  SELECT id, y, k, exp(s) / sum(exp(s)) OVER (PARTITION BY id) AS p FROM logits),
w2 AS (
  SELECT k, j, avg((p - CASE WHEN probs.y = k THEN 1 ELSE 0 END) * x) AS g
  FROM probs JOIN flat USING (id) GROUP BY k, j)
SELECT 'score' AS layer, CASE WHEN j = 64 THEN 'bias' ELSE 'weight' END AS param,
       CASE WHEN j = 64 THEN k ELSE k * 64 + j END AS idx, {r6('w - 0.2::DOUBLE * g')} AS value
FROM w1 JOIN w2 USING (k, j)
"""


def back(w: str, n_in: int, n_out: int, d: str) -> str:
    """Output errors times a weight matrix: errors of its inputs."""
    total = f"list_sum(list_transform(range({n_out}), lambda k: {w}[k + 1][j + 1] * {d}[k + 1]))"
    return f"list_transform(range({n_in}), lambda j: {total})"


def gated(d: str, h: str) -> str:
    """Errors that pass a rectifier with output ``h``."""
    return (
        f"list_transform(list_zip({d}, {h}), "
        "lambda v: CASE WHEN v[2] > 0 THEN v[1] ELSE 0::DOUBLE END)"
    )


def _gradient(weights: str, steps: list[tuple[str, str]], layers) -> str:
    """Mean over the rows of ``error x input`` for ``(layer, input, n_in, error, n_out)``."""
    sql = (
        f"WITH w AS (SELECT {weights}), "
        f"t0 AS (SELECT vec_id, label + 1 AS label1, {X} AS x FROM embeddings)"
    )
    for n, (name, expr) in enumerate(steps):
        prior = "t0, w" if n == 0 else f"t{n}"
        sql += f", t{n + 1} AS MATERIALIZED (SELECT *, {expr} AS {name} FROM {prior})"
    last, parts = f"t{len(steps)}", []
    for layer, x, n_in, d, n_out in layers:
        cells = f"(SELECT {x} AS h, {d} AS d, unnest(range({n_in * n_out})) AS i FROM {last})"
        value = r6(f"avg(d[i // {n_in} + 1] * h[i % {n_in} + 1])")
        parts.append(
            f"SELECT '{layer}' AS layer, 'weight' AS param, i AS idx, {value} AS value "
            f"FROM {cells} GROUP BY i"
        )
        cells = f"(SELECT {d} AS d, unnest(range({n_out})) AS i FROM {last})"
        parts.append(
            f"SELECT '{layer}', 'bias', i, {r6('avg(d[i + 1])')} FROM {cells} GROUP BY i"
        )
    return sql + " " + " UNION ALL ".join(parts)


def _mlp_gradient() -> str:
    weights = ", ".join(
        f"{matrix(o, i, 2 * n)} AS w{n}, {vector(o, 2 * n + 1)} AS b{n}"
        for n, (i, o) in enumerate(((64, H), (H, H), (H, 10)))
    )
    steps = [
        ("h1", mapped(affine("x", H, "w0", "b0"), RELU)),
        ("h2", mapped(affine("h1", H, "w1", "b1"), RELU)),
        ("z", affine("h2", 10, "w2", "b2")),
        ("lp", log_softmax("z")),
        ("d3", "list_transform(lp, lambda v, i: exp(v) - CASE WHEN i = label1 THEN 1 ELSE 0 END)"),
        ("d2", gated(back("w2", H, 10, "d3"), "h2")),
        ("d1", gated(back("w1", H, H, "d2"), "h1")),
    ]
    layers = [("fc1", "x", 64, "d1", H), ("fc2", "h1", H, "d2", H), ("fc3", "h2", H, "d3", 10)]
    return _gradient(weights, steps, layers)


def _autoencoder_gradient() -> str:
    weights = (
        f"{matrix(CODE, 64, 0)} AS w0, {vector(CODE, 1)} AS b0, "
        f"{matrix(64, CODE, 2)} AS w1, {vector(64, 3)} AS b1"
    )
    steps = [
        ("h", mapped(affine("x", CODE, "w0", "b0"), RELU)),
        ("y", mapped(affine("h", 64, "w1", "b1"), SIGMOID)),
        ("d2", "list_transform(list_zip(x, y), lambda v: 2 * (v[2] - v[1]) / 64 * v[2] * (1 - v[2]))"),
        ("d1", gated(back("w1", CODE, 64, "d2"), "h")),
    ]
    return _gradient(weights, steps, [("encoder", "x", 64, "d1", CODE), ("decoder", "h", CODE, "d2", 64)])


#: Training and held-out rows, both normalized by the statistics of the training rows.
ZS = (
    "e AS (SELECT vec_id AS id, label + 1 AS label1, embedding, "
    f"CASE WHEN {draw('vec_id', 42, 0)} < 3435973836 THEN 'train' ELSE 'test' END AS split FROM embeddings), "
    "st AS (SELECT avg(v) AS m, stddev_pop(v) AS s FROM "
    "(SELECT unnest(embedding)::DOUBLE AS v FROM e WHERE split = 'train')), "
    "z AS MATERIALIZED (SELECT id, label1, split, "
    "list_transform(embedding, lambda v: (v::DOUBLE - m) / s) AS features FROM e, st)"
)


def _adam(t: int, old: str, g: str, m: str, v: str) -> tuple[str, str, str]:
    """New value, first and second moment after step ``t`` (from 1) at rate 0.001."""
    m1 = f"(0.9::DOUBLE * {m} + 0.1::DOUBLE * {g})"
    v1 = f"(0.999::DOUBLE * {v} + 0.001::DOUBLE * {g} * {g})"
    hat_m, hat_v = f"{m1} / {1 - 0.9**t!r}::DOUBLE", f"{v1} / {1 - 0.999**t!r}::DOUBLE"
    return f"{old} - 0.001::DOUBLE * ({hat_m}) / (sqrt({hat_v}) + 1e-8::DOUBLE)", m1, v1


def _run(
    run_id: str, sizes: list[int], epochs: int, rate: float | None, batches: int = 1, renewed: int = 0,
    views: str | None = None,
) -> str:
    """Descent of a rectifier network on the training rows, measured on the held-out ones.

    ``rate`` None is Adam on the network that reproduces its input, without
    validation. Batches are hash classes of the key, dealt anew in every epoch. Per step: forward pass and
    errors of every row (``f``), mean gradients (``g``, ``c``), new weights
    (``p``); the logged loss is that before the step. After ``renewed`` steps the
    last layer starts afresh and a new run is logged. With ``views``, tables ``z0``, ``z1``, … are
    the samples of each epoch, and nothing is measured.
    """
    dense = list(zip(sizes, sizes[1:]))
    top, copying = len(dense) - 1, rate is None
    zeros = lambda o, i: f"list_transform(range({o}), lambda r: list_transform(range({i}), lambda c: 0::DOUBLE))"
    start = []
    for n, (i, o) in enumerate(dense):
        start += [f"{matrix(o, i, 2 * n)} AS w{n}", f"{vector(o, 2 * n + 1)} AS b{n}"]
        if copying:
            start += [f"{zeros(o, i)} AS {k}w{n}" for k in "mv"]
            start += [f"list_transform(range({o}), lambda c: 0::DOUBLE) AS {k}b{n}" for k in "mv"]
    sql = f"WITH {views or ZS}, p0 AS MATERIALIZED (SELECT {', '.join(start)})"
    forward, errors = [], []
    for n, (_, o) in enumerate(dense):
        out = affine("features" if n == 0 else f"h{n}", o, f"w{n}", f"b{n}")
        last = mapped(out, SIGMOID) if copying else log_softmax(out)
        forward.append((f"h{n + 1}", mapped(out, RELU) if n < top else last))
    y = f"h{top + 1}"
    if copying:
        loss = f"list_sum(list_transform(list_zip(features, {y}), lambda v: pow(v[2] - v[1], 2))) / {sizes[-1]}"
        off = (f"list_transform(list_zip(features, {y}), lambda v: "
               f"2 * (v[2] - v[1]) / {sizes[-1]} * v[2] * (1 - v[2]))")
    else:
        loss = f"-{y}[label1]"
        off = f"list_transform({y}, lambda v, i: exp(v) - CASE WHEN i = label1 THEN 1 ELSE 0 END)"
    errors.append((f"d{top + 1}", off))
    for n in range(top, 0, -1):
        wrong = back(f"w{n}", dense[n][0], dense[n][1], f"d{n + 1}")
        errors.append((f"d{n}", gated(wrong, f"h{n}")))

    def passed(rows: str, steps) -> str:
        for name, expr in steps:
            rows = f"(SELECT *, {expr} AS {name} FROM {rows})"
        return rows

    for t in range(epochs * batches):
        chosen, source = ("true", f"z{t // batches}") if views else ("split = 'train'", "z")
        if batches > 1:
            place = f"row_number() OVER (ORDER BY {draw('range', 0, t // batches)}, range) - 1"
            mine = f"SELECT range FROM (SELECT range, {place} AS place FROM range({4 * batches})) WHERE place % {batches} = {t % batches}"
            chosen += f" AND {draw('id', 0, 0)} % {4 * batches} IN ({mine})"
        rows = f"(SELECT * FROM (SELECT * FROM {source} WHERE {chosen}), p{t})"
        sql += f", f{t} AS MATERIALIZED {passed(rows, forward + errors)}"
        new, sources = [], [f"p{t}"]
        for n, (i, o) in enumerate(dense):
            h = "features" if n == 0 else f"h{n}"
            parts = (("g", i * o, f"{h}[q % {i} + 1] * d{n + 1}[q // {i} + 1]"), ("c", o, f"d{n + 1}[q + 1]"))
            for name, size, value in parts:
                sql += (
                    f", {name}{t}_{n} AS MATERIALIZED (SELECT list(v ORDER BY q) AS {name}{n} FROM "
                    f"(SELECT q, avg({value}) AS v FROM (SELECT *, unnest(range({size})) AS q FROM f{t}) GROUP BY q))"
                )
                sources.append(f"{name}{t}_{n}")
            grid = lambda body: f"list_transform(range({o}), lambda r: list_transform(range({i}), lambda c: {body}))"  # noqa: E731, B023
            line = lambda body: f"list_transform(range({o}), lambda r: {body})"  # noqa: E731, B023
            w, g, b, c = f"w{n}[r + 1][c + 1]", f"g{n}[r * {i} + c + 1]", f"b{n}[r + 1]", f"c{n}[r + 1]"
            if copying:
                for old, grad, name, spread in ((w, g, f"w{n}", grid), (b, c, f"b{n}", line)):
                    moved = _adam(t + 1, old, grad, f"m{old}", f"v{old}")
                    new += [f"{spread(e)} AS {k}{name}" for k, e in zip(("", "m", "v"), moved)]
            else:
                new.append(f"{grid(f'{w} - {rate}::DOUBLE * {g}')} AS w{n}")
                new.append(f"{line(f'{b} - {rate}::DOUBLE * {c}')} AS b{n}")
        if t + 1 == renewed:
            i, o = dense[top]
            new[-2:] = [f"{matrix(o, i, 2 * top)} AS w{top}", f"{vector(o, 2 * top + 1)} AS b{top}"]
        sql += f", p{t + 1} AS MATERIALIZED (SELECT {', '.join(new)} FROM {', '.join(sources)})"
    out = [
        f"SELECT '{run_id}' AS run_id, 'train' AS phase, 'Loss' AS tag, {t + 1 - renewed} AS step, "
        f"{r6(f'avg({loss})')} AS value FROM f{t}"
        for t in range(renewed, epochs * batches)
    ]
    for epoch in range(1 + renewed, 1 if copying or views else epochs + 1):
        held_out = passed(f"(SELECT * FROM (SELECT * FROM z WHERE split = 'test'), p{epoch * batches})", forward)
        hit = f"avg(CASE WHEN list_position({y}, list_max({y})) = label1 THEN 1 ELSE 0 END)"
        step = epoch * batches - renewed
        out.append(f"SELECT '{run_id}', 'val', 'Top1Accuracy', {step}, {r6(hit)} FROM {held_out}")
    return sql + " " + " UNION ALL ".join(out)


def _views(epochs: int, *steps) -> str:
    """Samples ``z0``, ``z1``, … of the images; every step is a function of the epoch."""
    sql = RGB
    for e in range(epochs):
        sql += f", y{e}_0 AS (SELECT vec_id, label + 1 AS label1, p FROM rgb)"
        for n, step in enumerate(steps):
            sql += f", y{e}_{n + 1} AS (SELECT vec_id, label1, {step(e)} AS p FROM y{e}_{n})"
        sql += f", z{e} AS MATERIALIZED (SELECT vec_id AS id, label1, p AS features FROM y{e}_{len(steps)})"
    return sql


def _local_head(result: str, workers: int = 8, size: int = 16, epochs: int = 2, steps: int = 8) -> str:
    """Worker-local steps of rate 0.01 and decay 2e-4 from the class means, averaged per epoch by rows.

    ``steps`` batches of ``size`` rows are more than any worker has at the scale of the checks.
    """
    sql = (
        f"WITH {CENTROIDS}, {Z}, zw AS MATERIALIZED (SELECT *, {draw('id', 0, 0)} % {workers} AS worker FROM z), "
        "p0 AS MATERIALIZED (SELECT (SELECT list(v ORDER BY idx) FROM params WHERE param = 'weight') AS w, "
        "(SELECT list(v ORDER BY idx) FROM params WHERE param = 'bias') AS b, 0 AS t), "
        "own AS MATERIALIZED (SELECT worker, count(*) AS n FROM zw GROUP BY worker)"
    )
    logits = (
        "list_transform(range(10), lambda k: list_dot_product(w[k * 64 + 1:k * 64 + 64], features) + b[k + 1])"
    )
    off = "list_transform(o, lambda v, i: exp(v) - CASE WHEN i = label1 THEN 1 ELSE 0 END)"
    for e in range(epochs):
        number = f"(row_number() OVER (PARTITION BY worker ORDER BY {draw('id', 0, e)}, id) - 1) // {size}"
        sql += f", r{e} AS MATERIALIZED (SELECT *, {number} AS step FROM zw)"
        sql += f", s{e}_0 AS MATERIALIZED (SELECT worker, w, b, t FROM own, p{e})"
        for s in range(steps):
            sql += (
                f", d{e}_{s} AS MATERIALIZED (SELECT worker, features, {off} AS d FROM "
                f"(SELECT *, {log_softmax(logits)} AS o FROM r{e} JOIN s{e}_{s} USING (worker) WHERE step = {s})), "
                f"g{e}_{s} AS MATERIALIZED (SELECT worker, list(v ORDER BY q) AS g FROM "
                "(SELECT worker, q, avg(CASE WHEN q < 640 THEN features[q % 64 + 1] * d[q // 64 + 1] "
                "ELSE d[q - 640 + 1] END) AS v "
                f"FROM (SELECT *, unnest(range(650)) AS q FROM d{e}_{s}) GROUP BY worker, q) GROUP BY worker), "
                f"s{e}_{s + 1} AS MATERIALIZED (SELECT worker, "
                + ", ".join(
                    f"CASE WHEN g IS NULL THEN {k} ELSE list_transform({k}, lambda v, i: "
                    f"v - 0.01::DOUBLE / (1 + t * 2e-4::DOUBLE) * g[i + {at}]) END AS {k}"
                    for k, at in (("w", 0), ("b", 640))
                )
                + f", t + CASE WHEN g IS NULL THEN 0 ELSE 1 END AS t FROM s{e}_{s} LEFT JOIN g{e}_{s} USING (worker))"
            )
        mean = lambda k, n: (
            f"(SELECT list(v ORDER BY q) FROM (SELECT q, sum(n * {k}[q + 1]) / sum(n) AS v FROM "
            f"(SELECT n, {k}, unnest(range({n})) AS q FROM s{e}_{steps} JOIN own USING (worker)) GROUP BY q))"  # noqa: B023
        )
        sql += (
            f", p{e + 1} AS MATERIALIZED (SELECT {mean('w', 640)} AS w, {mean('b', 10)} AS b, "
            f"(SELECT max(t) FROM s{e}_{steps}) AS t)"
        )
    if result == "weights":
        return (
            f"{sql} SELECT 'classifier' AS layer, 'weight' AS param, i AS idx, {r6('w[i + 1]')} AS value FROM "
            f"(SELECT w, unnest(range(640)) AS i FROM p{epochs}) UNION ALL SELECT 'classifier', 'bias', i, "
            f"{r6('b[i + 1]')} FROM (SELECT b, unnest(range(10)) AS i FROM p{epochs})"
        )
    if result == "log":
        made = " UNION ALL ".join(
            f"SELECT s.t, s.w, s.b FROM s{e}_{s + 1} s JOIN g{e}_{s} USING (worker) WHERE s.t % 3 = 0"
            for e in range(epochs) for s in range(steps)
        )
        values = " UNION ALL ".join(f"SELECT t, '{p}' AS param, unnest({c}) AS v FROM made" for p, c in (("weight", "w"), ("bias", "b")))
        return (
            f"{sql}, made AS ({made}) SELECT t::BIGINT AS step, 'classifier' AS layer, param, "
            "least(greatest(floor((v - (-0.1::DOUBLE)) / (0.2::DOUBLE / 20)), -1), 20)::INT AS bucket, "
            f"count(*) AS n FROM ({values}) GROUP BY ALL"
        )
    scored = f"(SELECT id, label1, {log_softmax(logits)} AS o FROM z, p{epochs})"
    return f"{sql} SELECT id, label1, {best('o')} + 1 AS class1 FROM {scored}"


_CELL = [("recurrent", p) for p in ("i2h", "h2h", "bias")]
_HEAD = [("score", "weight"), ("score", "bias")]


def all_oracles() -> dict[str, str]:
    from gradmill.catalog.queries import TABLES

    words = (
        "SELECT word, count(*) AS count FROM "
        "(SELECT unnest(string_split(text, ' ')) AS word FROM {}) GROUP BY word"
    )
    lines = (
        "SELECT doc_id, i AS line_no, l[i + 1] AS line FROM (SELECT doc_id, l, "
        "unnest(range(len(l))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"
    )
    one_hot_error = (
        "list_sum(list_transform(range(10), lambda k: "
        "pow(s[k + 1] - CASE WHEN k = label1 - 1 THEN 1 ELSE 0 END, 2))) / 10"
    )
    nearest = (
        "list_transform(range(72), lambda i: "
        "p[(((i // 18) * 8 // 4) * 8 + ((i // 3) % 6) * 8 // 6) * 3 + i % 3 + 1])"
    )
    views = {
        "image_samples_train": random_crop(8, 6, 6, 11, 0),
        "image_samples_val": crop(8, 6, 6, "1", "1"),
    }
    # fixed value: 4/5 of the range of the hash
    split = (
        f"CASE WHEN {draw('vec_id', 42, 0)} < 3435973836 THEN 'train' ELSE 'test' END AS split"
    )
    top5_linear = TOP5.format(scores="scores", source="scored").replace("score DESC", "round(score, 9) DESC")
    out = {
        "word_count": words.format("documents"),
        "word_count_turns": words.format("conversations"),
        "log_error_count": f"SELECT count(*) AS matches FROM ({lines}) WHERE line LIKE '%er%'",
        "event_error_count": "SELECT count(*) AS matches FROM events WHERE event_type LIKE '%error%'",
        "document_lines": lines,
        "json_props": "SELECT event_id, (props->>'k')::BIGINT AS k FROM events",
        "json_props_inferred": "SELECT event_id, (props->>'k')::BIGINT AS k FROM events",
        "json_nested_people": (
            "SELECT c_custkey, c_name AS name, c_mktsegment AS city, n_name AS state "
            "FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"
        ),
        "sql_view_filter": (
            "SELECT c_custkey, c_name, n_name AS name, c_acctbal "
            "FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_3'"
        ),
        "row_count": " UNION ALL ".join(
            f"SELECT '{t}' AS name, count(*) AS rows FROM {t}" for t in TABLES
        ),
        "row_count_by_label": "SELECT label, count(*) AS rows FROM embeddings GROUP BY label",
        "row_count_by_split": f"SELECT {split}, count(*) AS rows FROM embeddings GROUP BY split",
        "normalized_by_training_split": (
            f"WITH e AS (SELECT vec_id, embedding, {split} FROM embeddings), "
            "st AS (SELECT avg(v) AS m, stddev_pop(v) AS s FROM "
            "(SELECT unnest(embedding)::DOUBLE AS v FROM e WHERE split = 'train')), "
            "f AS (SELECT vec_id, split, list_transform(embedding, lambda v: (v::DOUBLE - m) / s) AS features "
            "FROM e, st) " + unnested("f", "vec_id, split", "features")
        ),
        "take_n": "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 8",
        "run_name": (
            "SELECT event_id, event_type || '-' || strftime(ts, '%Y%m%d-%H%M%S') AS run_name FROM events"
        ),
        "normalizer_stats": f"WITH {STATS} SELECT n, {r6('m')} AS mean, {r6('s')} AS std FROM stats",
        "mnist_like_samples": f"WITH {Z} {unnested('z', 'id, label1', 'features')}",
        "zero_based_labels": "SELECT vec_id, label + 1 AS label1, label FROM embeddings",
        "zip_by_position": (
            "WITH a AS (SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, o_orderkey, o_custkey FROM orders), "
            "b AS (SELECT row_number() OVER (ORDER BY -o_orderkey) - 1 AS pos, -o_orderkey AS back, o_totalprice FROM orders) "
            "SELECT * FROM a JOIN b USING (pos)"
        ),
        "reshape2d": (
            f"SELECT vec_id, i // 8 AS row, i % 8 AS col, {r6('embedding[i + 1]::DOUBLE')} AS value "
            "FROM (SELECT *, unnest(range(64)) AS i FROM embeddings)"
        ),
        "self_target": (
            f"WITH {Z} SELECT id, len(features) AS n_features, len(features) AS n_target, "
            "0::DOUBLE AS mse_self, "
            f"{r6('list_sum(list_transform(features, lambda v: v * v)) / 64')} AS mse_zero FROM z"
        ),
        "minmax_scale": (
            "WITH r AS (SELECT min(list_min(embedding))::DOUBLE AS lo, max(list_max(embedding))::DOUBLE AS hi "
            "FROM embeddings), t AS (SELECT vec_id, list_transform(embedding, "
            "lambda v: (v::DOUBLE - lo) / (hi - lo)) AS s FROM embeddings, r) "
            + unnested("t", "vec_id", "s")
        ),
        "minibatches": (
            f"SELECT vec_id, {draw('vec_id', 0, 0)} % 8 AS epoch0, {draw('vec_id', 0, 1)} % 8 AS epoch1 "
            "FROM embeddings"
        ),
        "scale_u8": pixels(U8),
        "scale_pm1": pixels("list_transform(p, lambda v: (v / 127.5::DOUBLE - 1)::FLOAT)"),
        "resize_nearest": pixels(nearest),
        "resize_bilinear": pixels(bilinear(6)),
        "crop_center": pixels(crop(8, 6, 5, "1", "1")),
        "crop_random": pixels(random_crop(8, 6, 5, 3, 1)),
        "flip_random": pixels(random_flip(8, 5, 2)),
        "channel_normalize": pixels(U8, NORMALIZED),
        "to_chw": pixels(chw(8)),
        "image_folder": f"WITH {RGB} {unnested('rgb', 'vec_id, label', 'p')}",
        "named_images": (
            f"WITH {RGB}, n AS (SELECT 'image ' || vec_id AS name, p FROM rgb) {unnested('n', 'name', 'p')}"
        ),
        "text_lines": "SELECT c_name AS line FROM customer",
        "image_sequence": (
            f"WITH {RGB} SELECT label::VARCHAR AS label_name, i AS idx, count(*) AS n, "
            "sum(p[i + 1])::BIGINT AS total "
            "FROM (SELECT *, unnest(range(192)) AS i FROM rgb) GROUP BY ALL"
        ),
        "idx_files": (
            f"WITH {RGB}, t AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, label, g FROM grey) "
            + unnested("t", "id, label", "g")
        ),
        "class_list": (
            "SELECT n_nationkey AS class_id, i AS idx, "
            "CASE WHEN i = 0 THEN n_name ELSE 'region ' || n_regionkey END AS synonym "
            "FROM (SELECT *, unnest(range(2)) AS i FROM nation)"
        ),
        "label_lines": "SELECT n_nationkey AS class_id, n_name AS name FROM nation",
        "score_linear": f"WITH {LINEAR} {unnested('scored', 'vec_id', 'scores', 'score')}",
        "predict_class": (
            f"WITH {LINEAR} SELECT vec_id, label1 AS truth1, {best('scores')} + 1 AS class1 FROM scored"
        ),
        "argmax": "SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS best FROM embeddings",
        "top_k": (
            f"SELECT vec_id, rank - 1 AS rank, class_id, {r6('score')} AS score FROM "
            f"({TOP5.format(scores='embedding', source='embeddings')})"
        ),
        "top_k_named": (
            f"WITH {LINEAR} SELECT vec_id, rank, class_id, n_name AS name, {r6('score')} AS score FROM "
            f"({top5_linear}) LEFT JOIN nation ON n_nationkey = class_id"
        ),
        "class_name_lookup": (
            "SELECT vec_id, label AS class_id, n_name AS name FROM embeddings LEFT JOIN nation ON label = n_nationkey"
        ),
        "order_customers": (
            "SELECT o_custkey AS class_id, o_orderkey, c_name AS name FROM orders "
            "LEFT JOIN customer ON o_custkey = c_custkey"
        ),
        "scores_by_name": (
            f"WITH {LINEAR} SELECT vec_id, n_regionkey::VARCHAR AS name, "
            f"{r6('arg_max(scores[i + 1], i)')} AS score "
            "FROM (SELECT *, unnest(range(10)) AS i FROM scored) LEFT JOIN nation ON n_nationkey = i "
            "GROUP BY vec_id, n_regionkey"
        ),
        "prediction_and_truth": (
            f"WITH {LINEAR} SELECT vec_id AS id, label1 - 1 AS truth, {best('scores')} AS pred FROM scored"
        ),
        "written_predictions": (
            f"WITH {LINEAR} SELECT vec_id AS id, label1 - 1 AS truth, {best('scores')} AS pred FROM scored"
        ),
        "top1_accuracy": (
            f"WITH {LINEAR} SELECT {r6(f'avg(CASE WHEN {best("scores")} = label1 - 1 THEN 1 ELSE 0 END)')} "
            "AS top1 FROM scored"
        ),
        "label_agreement": (
            f"SELECT {r6('avg(CASE WHEN quality = toxic THEN 1 ELSE 0 END)')} AS agreement FROM labels"
        ),
        "mean_loss": f"WITH {LINEAR} SELECT {r6('avg(-scores[label1])')} AS loss FROM scored",
        "criteria": (
            f"WITH {LINEAR} SELECT vec_id, {r6('-scores[label1]')} AS nll, "
            f"{r6('-scores[label1]')} AS cross_entropy, {r6(one_hot_error)} AS mse FROM scored"
        ),
        "stream_score": f"WITH {LINEAR} SELECT vec_id, {best('scores')} AS pred FROM scored",
        "predictions_in_tables": f"WITH {LINEAR} SELECT vec_id AS id, label AS truth, {best('scores')} AS pred FROM scored "
        "JOIN embeddings USING (vec_id)",
        "classify_images": (
            f"{_picture('255')} SELECT vec_id, class_id, n_name AS name FROM "
            f"(SELECT vec_id, {best('scores')} + 1 AS class_id FROM scored) "
            "LEFT JOIN nation ON n_nationkey = class_id"
        ),
        "classify_named": (
            f"{_picture('pm1')} SELECT vec_id, rank, class_id, n_name AS name, {r6('score')} AS score "
            f"FROM ({top5_linear}) LEFT JOIN nation ON n_nationkey = class_id"
        ),
        "param_shapes": (
            "SELECT 'score' AS layer, 'weight' AS param, count(DISTINCT label) || 'x' || max(len(embedding)) AS shape, "
            "count(DISTINCT label) * max(len(embedding)) AS n_values FROM embeddings UNION ALL "
            "SELECT 'score', 'bias', count(DISTINCT label)::VARCHAR, count(DISTINCT label) FROM embeddings"
        ),
        "param_histogram": (
            f"WITH {CENTROIDS} SELECT layer, param, "
            "least(greatest(floor((v - (-0.1::DOUBLE)) / (0.2::DOUBLE / 20)), -1), 20)::INT AS bucket, "
            "count(*) AS n FROM params GROUP BY ALL"
        ),
        "saved_model": f"WITH {CENTROIDS} SELECT layer, param, idx, {r6('v')} AS value FROM params",
        "quantize": f"WITH {CENTROIDS} SELECT layer, param, idx, q FROM q",
        "size_report": (
            f"WITH {CENTROIDS}, a AS (SELECT 4 * count(*) AS float_bytes, "
            "count(*) + 4 * (SELECT count(*) FROM scales) AS int8_bytes FROM params) "
            "SELECT float_bytes, int8_bytes, float_bytes - int8_bytes AS saved_bytes FROM a"
        ),
        "quantized_predictions": f"{QUANTIZED} SELECT vec_id, pred, pred_q FROM preds",
        "quant_agreement": (
            f"{QUANTIZED} SELECT {r6('avg(CASE WHEN pred = pred_q THEN 1 ELSE 0 END)')} AS agreement FROM preds"
        ),
        "warm_start": (
            f"WITH {CENTROIDS} SELECT layer, param, idx, {r6('v')} AS value FROM params WHERE param = 'weight' "
            f"UNION ALL SELECT 'score', 'bias', i, {r6(cell('0', 'i', 1))} FROM (SELECT unnest(range(10)) AS i)"
        ),
        "metrics_log": (
            "SELECT event_id AS step, value FROM events WHERE event_type = 'click' AND event_id % 2 = 0"
        ),
        "softmax_grad_zero": GRAD_ZERO,
        "mlp_gradient": _mlp_gradient(),
        "lenet_slopes": _slopes(
            _lenet,
            [(layer, p) for layer in ("conv1", "conv2", "fc1", "score") for p in ("weight", "bias")],
            False,
        ),
        "rnn_slopes": _slopes(_rnn, _CELL + _HEAD, True),
        "lstm_slopes": _slopes(_lstm, _CELL + _HEAD, True),
        "birnn_slopes": _slopes(
            _birnn, [("recurrent", f"{side}_{p}") for side in ("fw", "bw") for _, p in _CELL] + _HEAD, True
        ),
        "autoencoder_gradient": _autoencoder_gradient(),
        "softmax_sync_steps": _sync_steps(),
        "resumed_training": _sync_steps(),
        "train_softmax_full_batch": _run("softmax-run", [64, 10], 20, 0.2),
        "train_mlp_full_batch": _run("mlp-run", [64, H, H, 10], 15, 0.2),
        # four batches: 128 rows each of about 400
        "train_softmax": _run("softmax-run", [64, 10], 5, 0.2, 4),
        "train_images": _run("images-run", [108, 10], 3, 0.2, 4, views=_views(
            3, lambda e: U8, lambda e: random_crop(8, 6, 6, 11, e), lambda e: random_flip(6, 12, e), lambda e: NORMALIZED,
            lambda e: chw(6))),
        "train_mlp": _run("mlp-run", [64, H, H, 10], 3, 0.2, 4),
        "transfer_trunk": _run("trunk-run", [64, H, H, 10], 5, 0.2, renewed=2),
        "transfer_head": _local_head("classes"),
        "transfer_head_weights": _local_head("weights"),
        "param_log": _local_head("log"),
        "train_autoencoder": _run("autoencoder-run", [64, CODE, 64], 2, None, 4),
        "score_mlp": _scores(_mlp()),
        "score_lenet": _scores(_lenet()),
        "score_rnn": _scores(_rnn()),
        "score_lstm": _scores(_lstm()),
        "score_birnn": _scores(_birnn()),
        "score_autoencoder": _scores(_autoencoder()),
    }
    for name, cut in views.items():
        out[name] = pixels(BGR, U8, cut, random_flip(6, 12, 0), NORMALIZED, chw(6), keep="vec_id, label1")
    return out
