"""Queries for tensor layers, scoring and layer gradients.

Input images are the ``embeddings`` vectors viewed as 8×8×1. The oracle network is
conv 2@3×3 → ReLU → avg-pool 2×2 → flatten 18 → dense 10 → softmax with formula weights.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import r6
from ..operators import grads as G
from ..operators import metrics
from ..operators import tensor as T
from ..operators.quality import probability_sums
from ..plans import kernels as K
from ..plans.scoring import feature_maps, score
from ..sources.tables import read_table
from . import register
from .fixtures import (
    CELLS_SQL,
    IMG_C,
    IMG_H,
    IMG_W,
    conv_bias_sql,
    conv_weights,
    conv_weights_sql,
    dense_bias_sql,
    dense_weights,
    dense_weights_sql,
    image_cells,
)

R = "round({}, 6) + 0.0"


# ----------------------------------------------------------------------------- SQL pieces
def _win_sql(src: str, k: int, s: int, h: int, w: int) -> str:
    oh, ow = (h - k) // s + 1, (w - k) // s + 1
    return f"""SELECT id, CAST((y - dy) // {s} AS BIGINT) AS oy, CAST((x - dx) // {s} AS BIGINT) AS ox, c,
       CAST(dy AS BIGINT) AS dy, CAST(dx AS BIGINT) AS dx, v
FROM {src}, range({k}) a(dy), range({k}) b(dx)
WHERE y - dy >= 0 AND x - dx >= 0 AND (y - dy) % {s} = 0 AND (x - dx) % {s} = 0
  AND y - dy < {oh * s} AND x - dx < {ow * s}"""


BASE = f"""cells AS ({CELLS_SQL}),
wconv AS ({conv_weights_sql()}),
bconv AS ({conv_bias_sql()}),
win AS ({_win_sql("cells", 3, 1, 8, 8)}),
conv AS (SELECT id, oy AS y, ox AS x, f AS c, sum(v * w) + b AS v FROM win JOIN wconv USING (c, dy, dx) JOIN bconv USING (f)
         GROUP BY id, oy, ox, f, b)"""

CNN = f"""{BASE},
relu AS (SELECT id, y, x, c, greatest(v, 0.0) AS v FROM conv),
pooled AS (SELECT id, oy AS y, ox AS x, c, sum(v) / 4.0 AS v
           FROM (SELECT id, y // 2 AS oy, x // 2 AS ox, c, v FROM relu WHERE y < 6 AND x < 6) GROUP BY id, oy, ox, c),
flat AS (SELECT id, CAST((y * 3 + x) * 2 + c AS BIGINT) AS i, v FROM pooled),
wd AS ({dense_weights_sql(18, 10)}),
bd AS ({dense_bias_sql(10)}),
logits AS (SELECT id, j, sum(v * w) + b AS z FROM flat JOIN wd USING (i) JOIN bd USING (j) GROUP BY id, j, b),
ex AS (SELECT id, j, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM logits),
probs AS (SELECT id, j, e / sum(e) OVER (PARTITION BY id) AS p FROM ex)"""

VEC = """vec AS (SELECT CAST(vec_id AS BIGINT) AS id, CAST(pos AS BIGINT) AS i, CAST(v AS DOUBLE) AS v
        FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS pos FROM embeddings))"""

MLP = f"""{VEC},
w1 AS ({dense_weights_sql(64, 16)}), b1 AS ({dense_bias_sql(16)}),
w2 AS (SELECT i, j, w FROM ({dense_weights_sql(16, 10)})), b2 AS ({dense_bias_sql(10)}),
hid AS (SELECT id, j AS i, greatest(sum(v * w) + b, 0.0) AS v FROM vec JOIN w1 USING (i) JOIN b1 USING (j) GROUP BY id, j, b),
logits AS (SELECT id, j, sum(v * w) + b AS z FROM hid JOIN w2 USING (i) JOIN b2 USING (j) GROUP BY id, j, b),
ex AS (SELECT id, j, exp(z - max(z) OVER (PARTITION BY id)) AS e FROM logits),
probs AS (SELECT id, j, e / sum(e) OVER (PARTITION BY id) AS p FROM ex)"""


# ----------------------------------------------------------------------------- Spark pieces
def _cells(spark, sf):
    return image_cells(spark, sf)


def _conv_tables(spark):
    w, b = conv_weights()
    return T.conv_weight_table(spark, w, b)


def _conv_out(spark, sf):
    wdf, bdf = _conv_tables(spark)
    return T.conv2d(_cells(spark, sf), wdf, bdf, 3, 3, 1, IMG_H, IMG_W, n_params=18)


def _cnn_net():
    layers = [K.conv(2, 1, 3), K.act("relu"), K.pool(2, 2, "avg"), K.flatten(), K.dense(18, 10, "softmax")]
    cw, cb = conv_weights()
    dw, db = dense_weights(18, 10)
    params = [{"W": cw, "b": cb}, None, None, None, {"W": dw, "b": db}]
    return layers, params


def _mlp_net():
    layers = [K.dense(64, 16, "relu"), K.dense(16, 10, "softmax")]
    w1, b1 = dense_weights(64, 16)
    w2, b2 = dense_weights(16, 10)
    return layers, [{"W": w1, "b": b1}, {"W": w2, "b": b2}]


def _emb(spark, sf):
    return read_table(spark, sf, "embeddings").select(F.col("vec_id").cast("bigint").alias("id"), "label", F.col("embedding").alias("data"))


def _cells_out(df, col="v"):
    return df.select("id", "y", "x", "c", r6(col).alias("v"))


# ----------------------------------------------------------------------------- layout ops
@register(
    "tensor_cast_channel",
    """
SELECT vec_id, 8 AS h, 8 AS w, 1 AS c, CAST(len(embedding) AS BIGINT) AS n,
       round(list_sum(list_transform(embedding, lambda z: CAST(CAST(z AS FLOAT) AS DOUBLE))), 6) + 0.0 AS total
FROM embeddings
""",
)
def q_tensor_cast_channel(spark, sf):
    e = read_table(spark, sf, "embeddings")
    t = T.with_channel(e, "embedding", IMG_H, IMG_W, IMG_C, out="data")
    total = F.aggregate(F.transform("data", lambda z: z.cast("double")), F.lit(0.0), lambda a, z: a + z)
    return t.select("vec_id", "h", "w", "c", F.size("data").cast("bigint").alias("n"), r6(total).alias("total"))


@register(
    "tensor_pad",
    """
SELECT CAST(vec_id AS BIGINT) AS id, CAST(pos // 10 AS BIGINT) AS y, CAST(pos % 10 AS BIGINT) AS x, CAST(0 AS BIGINT) AS c,
       round(CASE WHEN pos // 10 BETWEEN 1 AND 8 AND pos % 10 BETWEEN 1 AND 8
                  THEN CAST(embedding[(pos // 10 - 1) * 8 + (pos % 10 - 1) + 1] AS DOUBLE) ELSE 0.0 END, 6) + 0.0 AS v
FROM embeddings, range(100) t(pos)
""",
)
def q_tensor_pad(spark, sf):
    e = read_table(spark, sf, "embeddings")
    p = T.pad_dense_packed(e, "embedding", IMG_H, IMG_W, IMG_C, 1, out="padded")
    return _cells_out(T.to_cells(p, "vec_id", "padded", IMG_H + 2, IMG_W + 2, IMG_C, partition=False))


@register("tensor_im2col", f"WITH cells AS ({CELLS_SQL}) SELECT id, oy, ox, c, dy, dx, {R.format('v')} AS v FROM ({_win_sql('cells', 3, 2, 8, 8)})")
def q_tensor_im2col(spark, sf):
    w = T.im2col(_cells(spark, sf), 3, 3, 2, IMG_H, IMG_W)
    return w.withColumn("v", r6("v"))


def _col2im_sql(agg: str) -> str:
    return f"""WITH cells AS ({CELLS_SQL}), win AS ({_win_sql('cells', 3, 1, 8, 8)})
SELECT id, oy + dy AS y, ox + dx AS x, c, {R.format(f'{agg}(v * (dy * 3 + dx + 1))')} AS v FROM win GROUP BY id, oy + dy, ox + dx, c"""


def _col2im_query(agg):
    def q(spark, sf):
        w = T.im2col(_cells(spark, sf), 3, 3, 1, IMG_H, IMG_W)
        w = w.withColumn("v", F.col("v") * (F.col("dy") * 3 + F.col("dx") + 1))  # distinct per-window values
        return _cells_out(T.col2im(w, 1, agg))

    return q


register("tensor_col2im", _col2im_sql("avg"))(_col2im_query("avg"))
register("tensor_col2im_sum", _col2im_sql("sum"))(_col2im_query("sum"))


@register("tensor_conv2d", f"WITH {BASE} SELECT id, y, x, c, {R.format('v')} AS v FROM conv")
def q_tensor_conv2d(spark, sf):
    return _cells_out(_conv_out(spark, sf))


@register(
    "tensor_conv2d_padded",
    f"""WITH cells0 AS ({CELLS_SQL}),
cells AS (SELECT id, y + 1 AS y, x + 1 AS x, c, v FROM cells0),
wconv AS ({conv_weights_sql()}), bconv AS ({conv_bias_sql()}),
win AS ({_win_sql("cells", 3, 2, 10, 10)})
SELECT id, oy AS y, ox AS x, f AS c, {R.format('sum(v * w) + b')} AS v FROM win JOIN wconv USING (c, dy, dx) JOIN bconv USING (f)
GROUP BY id, oy, ox, f, b""",
)
def q_tensor_conv2d_padded(spark, sf):
    wdf, bdf = _conv_tables(spark)
    padded = T.pad(_cells(spark, sf), 1, IMG_H, IMG_W)
    return _cells_out(T.conv2d(padded, wdf, bdf, 3, 3, 2, IMG_H + 2, IMG_W + 2, n_params=18))


@register(
    "tensor_maxpool_padded",
    f"""WITH cells0 AS ({CELLS_SQL}),
grid AS (SELECT id, c, g.range // {IMG_W + 4} AS y, g.range % {IMG_W + 4} AS x FROM (SELECT DISTINCT id, c FROM cells0), range({(IMG_H + 4) * (IMG_W + 4)}) g),
padded AS (SELECT g.id, g.c, g.y, g.x, coalesce(k.v, 0.0) AS v FROM grid g LEFT JOIN cells0 k ON k.id = g.id AND k.c = g.c AND k.y = g.y - 2 AND k.x = g.x - 2)
SELECT id, CAST(y // 2 AS BIGINT) AS y, CAST(x // 2 AS BIGINT) AS x, c, {R.format('max(v)')} AS v FROM padded GROUP BY id, y // 2, x // 2, c""",
)
def q_tensor_maxpool_padded(spark, sf):
    """Two rings of padding under a 2×2 kernel: windows made of padding alone give their cells."""
    padded = T.pad(_cells(spark, sf), 2, IMG_H, IMG_W)
    return _cells_out(T.pool(padded, 2, 2, IMG_H + 4, IMG_W + 4, "max"))


# ----------------------------------------------------------------------------- activations
def _act_sql(expr: str) -> str:
    return f"WITH cells AS ({CELLS_SQL}) SELECT id, y, x, c, {R.format(expr)} AS v FROM cells"


def _act_query(fn):
    def q(spark, sf):
        cells = image_cells(spark, sf, partition=False)  # element-wise: no clustering needed
        return _cells_out(T.activate(cells.withColumn("v", F.col("v") * 10.0), fn))

    return q


for _name, _fn, _expr in [
    ("act_relu", "relu", "greatest(v * 10.0, 0.0)"),
    ("act_tanh", "tanh", "tanh(v * 10.0)"),
    ("act_sigmoid", "sigmoid", "1.0 / (1.0 + exp(-(v * 10.0)))"),
    ("act_relu_grad", "relu_grad", "CAST(CASE WHEN v * 10.0 > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE)"),
    ("act_tanh_grad", "tanh_grad", "1.0 - tanh(v * 10.0) * tanh(v * 10.0)"),
    ("act_sigmoid_grad", "sigmoid_grad", "(1.0 / (1.0 + exp(-(v * 10.0)))) * (1.0 - 1.0 / (1.0 + exp(-(v * 10.0))))"),
]:
    register(_name, _act_sql(_expr))(_act_query(_fn))


@register(
    "act_softmax",
    f"""WITH cells AS ({CELLS_SQL}),
ex AS (SELECT id, y * 8 + x AS j, exp(v * 10.0 - max(v * 10.0) OVER (PARTITION BY id)) AS e FROM cells)
SELECT id, CAST(j AS BIGINT) AS j, {R.format('e / sum(e) OVER (PARTITION BY id)')} AS v FROM ex""",
)
def q_act_softmax(spark, sf):
    vec = T.flatten(_cells(spark, sf), IMG_W, IMG_C).select("id", F.col("i").alias("j"), (F.col("v") * 10.0).alias("v"))
    return T.softmax_cells(vec).select("id", "j", r6("v").alias("v"))


@register(
    "act_softmax_packed",
    """
WITH z AS (SELECT vec_id, list_transform(embedding, lambda t: CAST(t AS DOUBLE) * 10.0) AS z FROM embeddings),
e AS (SELECT vec_id, list_transform(z, lambda t: exp(t - list_max(z))) AS e FROM z)
SELECT vec_id, CAST(j - 1 AS BIGINT) AS j, round(e[j] / list_sum(e), 6) + 0.0 AS v FROM e, range(1, 65) t(j)
""",
)
def q_act_softmax_packed(spark, sf):
    from ..functions.activations import array_softmax

    e = read_table(spark, sf, "embeddings")
    s = e.select("vec_id", array_softmax(F.transform("embedding", lambda t: t.cast("double") * 10.0)).alias("p"))
    return s.select("vec_id", F.posexplode("p").alias("j", "v")).select("vec_id", F.col("j").cast("bigint").alias("j"), r6("v").alias("v"))


# ----------------------------------------------------------------------------- pooling
def _pool_sql(k: int, s: int, agg: str) -> str:
    red = "sum(v) / " + f"{float(k * k)}" if agg == "avg" else "max(v)"
    return f"""WITH cells AS ({CELLS_SQL}), win AS ({_win_sql('cells', k, s, 8, 8)})
SELECT id, oy AS y, ox AS x, c, {R.format(red)} AS v FROM win GROUP BY id, oy, ox, c"""


def _pool_query(k, s, mode):
    def q(spark, sf):
        return _cells_out(T.pool(_cells(spark, sf), k, s, IMG_H, IMG_W, mode))

    return q


register("pool_avg", _pool_sql(2, 2, "avg"))(_pool_query(2, 2, "avg"))
register("pool_max", _pool_sql(2, 2, "max"))(_pool_query(2, 2, "max"))
register("pool_max_overlap", _pool_sql(3, 2, "max"))(_pool_query(3, 2, "max"))
register("pool_avg_overlap", _pool_sql(3, 2, "avg"))(_pool_query(3, 2, "avg"))


# ----------------------------------------------------------------------------- flatten, dense
@register("tensor_flatten", f"WITH {BASE} SELECT id, CAST((y * 6 + x) * 2 + c AS BIGINT) AS i, {R.format('v')} AS v FROM conv")
def q_tensor_flatten(spark, sf):
    return T.flatten(_conv_out(spark, sf), 6, 2).withColumn("v", r6("v"))


@register(
    "tensor_unflatten",
    f"WITH {VEC} SELECT id, CAST(i // 16 AS BIGINT) AS y, CAST((i // 4) % 4 AS BIGINT) AS x, CAST(i % 4 AS BIGINT) AS c, {R.format('v')} AS v FROM vec",
)
def q_tensor_unflatten(spark, sf):
    e = read_table(spark, sf, "embeddings")
    vec = T.to_vectors(e, "vec_id", "embedding", partition=False)
    return _cells_out(T.unflatten(vec, 4, 4))


@register(
    "tensor_dense",
    f"""WITH {VEC}, w1 AS ({dense_weights_sql(64, 16)}), b1 AS ({dense_bias_sql(16)})
SELECT id, j, {R.format('greatest(sum(v * w) + b, 0.0)')} AS v FROM vec JOIN w1 USING (i) JOIN b1 USING (j) GROUP BY id, j, b""",
)
def q_tensor_dense(spark, sf):
    e = read_table(spark, sf, "embeddings")
    vec = T.to_vectors(e, "vec_id", "embedding")
    w, b = dense_weights(64, 16)
    wdf, bdf = T.dense_weight_table(spark, w, b)
    return T.dense(vec, wdf, bdf, "relu", n_params=w.size).withColumn("v", r6("v"))


@register(
    "feature_maps",
    f"""WITH {BASE}
SELECT y, x, {R.format('greatest(v, 0.0)')} AS v FROM conv WHERE c = 1 AND id = (SELECT min(vec_id) FROM embeddings)""",
)
def q_feature_maps(spark, sf):
    """Maps after layer 1 (ReLU) of the first sample, channel 1, from the packed forward pass."""
    layers, params = _cnn_net()
    e = _emb(spark, sf)
    first = e.agg(F.min("id")).first()[0]
    maps = feature_maps(e.where(F.col("id") == first), layers, params, (IMG_H, IMG_W, IMG_C), upto=1)
    return maps.where(F.col("c") == 1).select("y", "x", r6("v").alias("v"))


# ----------------------------------------------------------------------------- networks
@register("net_forward_cnn", f"WITH {CNN} SELECT id, CAST(j AS BIGINT) AS j, {R.format('p')} AS p FROM probs")
def q_net_forward_cnn(spark, sf):
    layers, params = _cnn_net()
    s = score(_emb(spark, sf), layers, params, (IMG_H, IMG_W, IMG_C), keep=["id"])
    return s.select("id", F.posexplode("probs").alias("j", "p")).select("id", F.col("j").cast("bigint").alias("j"), r6("p").alias("p"))


@register(
    "net_forward_cnn_cells",
    f"WITH {CNN} SELECT id, CAST(j AS BIGINT) AS j, {R.format('p')} AS p FROM probs",
)
def q_net_forward_cnn_cells(spark, sf):
    """The same network run entirely as cell-form relational operators."""
    layers, params = _cnn_net()
    conv = _conv_out(spark, sf)
    relu = T.activate(conv, "relu")
    pooled = T.pool(relu, 2, 2, 6, 6, "avg")
    flat = T.flatten(pooled, 3, 2)
    wdf, bdf = T.dense_weight_table(spark, params[4]["W"], params[4]["b"])
    probs = T.dense(flat, wdf, bdf, "softmax", n_params=180)
    return probs.select("id", "j", r6("v").alias("p"))


@register("net_forward_mlp", f"WITH {MLP} SELECT id, CAST(j AS BIGINT) AS j, {R.format('p')} AS p FROM probs")
def q_net_forward_mlp(spark, sf):
    layers, params = _mlp_net()
    s = score(_emb(spark, sf), layers, params, (64,), keep=["id"])
    return s.select("id", F.posexplode("probs").alias("j", "p")).select("id", F.col("j").cast("bigint").alias("j"), r6("p").alias("p"))


@register(
    "dq_probabilities",
    f"""WITH {MLP},
per AS (SELECT id, bool_or(p IS NULL OR NOT isfinite(p) OR p < 0 OR p > 1) OR abs(sum(p) - 1) > 1e-6 AS off FROM probs GROUP BY id)
SELECT count(*) AS n_rows, count_if(coalesce(off, TRUE))::BIGINT AS n_off FROM embeddings LEFT JOIN per ON id = vec_id""",
)
def q_dq_probabilities(spark, sf):
    """Softmax-sum check of the predicted probabilities of all rows."""
    layers, params = _mlp_net()
    return probability_sums(score(_emb(spark, sf), layers, params, (64,), keep=["id"]), "probs")


def _pred_sql(net: str) -> str:
    return f"""WITH {net},
rk AS (SELECT id, j, row_number() OVER (PARTITION BY id ORDER BY p DESC, j) AS r FROM probs)
SELECT id, CAST(j AS BIGINT) AS predicted FROM rk WHERE r = 1"""


@register("predict_cnn", _pred_sql(CNN))
def q_predict_cnn(spark, sf):
    layers, params = _cnn_net()
    return score(_emb(spark, sf), layers, params, (IMG_H, IMG_W, IMG_C), keep=["id"]).select("id", "predicted")


@register("predict_mlp", _pred_sql(MLP))
def q_predict_mlp(spark, sf):
    layers, params = _mlp_net()
    return score(_emb(spark, sf), layers, params, (64,), keep=["id"]).select("id", "predicted")


@register(
    "metric_cross_entropy",
    f"""WITH {CNN},
lab AS (SELECT CAST(vec_id AS BIGINT) AS id, label FROM embeddings),
pt AS (SELECT id, p FROM probs JOIN lab USING (id) WHERE j = label),
rk AS (SELECT id, j, row_number() OVER (PARTITION BY id ORDER BY p DESC, j) AS r FROM probs),
pr AS (SELECT id, j AS predicted FROM rk WHERE r = 1)
SELECT round(avg(-ln(greatest(least(p, 1 - 1e-15), 1e-15))), 6) + 0.0 AS loss_clip,
       round(avg(-ln(p + 1e-15)), 6) + 0.0 AS loss_add,
       round(avg(CAST(predicted = label AS DOUBLE)), 6) + 0.0 AS accuracy
FROM pt JOIN pr USING (id) JOIN lab USING (id)""",
)
def q_metric_cross_entropy(spark, sf):
    layers, params = _cnn_net()
    s = score(_emb(spark, sf), layers, params, (IMG_H, IMG_W, IMG_C), keep=["id", "label"])
    return s.agg(
        r6(F.avg(metrics.cross_entropy_terms("probs", "label", "clip"))).alias("loss_clip"),
        r6(F.avg(metrics.cross_entropy_terms("probs", "label", "add"))).alias("loss_add"),
        r6(F.avg((F.col("predicted") == F.col("label")).cast("double"))).alias("accuracy"),
    )


# ----------------------------------------------------------------------------- gradients
def _mlp_logit_grad_sql() -> str:
    return f"""{MLP},
lab AS (SELECT CAST(vec_id AS BIGINT) AS id, label FROM embeddings),
dz AS (SELECT id, j, p - CASE WHEN j = label THEN 1.0 ELSE 0.0 END AS g FROM probs JOIN lab USING (id))"""


@register("grad_softmax_ce", f"WITH {_mlp_logit_grad_sql()} SELECT id, CAST(j AS BIGINT) AS j, {R.format('g')} AS g FROM dz")
def q_grad_softmax_ce(spark, sf):
    layers, params = _mlp_net()
    s = score(_emb(spark, sf), layers, params, (64,), keep=["id", "label"])
    probs = s.select("id", F.posexplode("probs").alias("j", "v")).withColumn("j", F.col("j").cast("bigint"))
    g = G.softmax_ce(probs, s.select("id", F.col("label").cast("bigint").alias("label")))
    return g.select("id", "j", r6("g").alias("g"))


def _mlp_dense2_grads(spark, sf):
    """Backward through the MLP's output layer, all in cell form."""
    layers, params = _mlp_net()
    e = read_table(spark, sf, "embeddings")
    vec = T.to_vectors(e, "vec_id", "embedding")
    w1, b1 = T.dense_weight_table(spark, params[0]["W"], params[0]["b"])
    w2, b2 = T.dense_weight_table(spark, params[1]["W"], params[1]["b"])
    hid = T.dense(vec, w1, b1, "relu", n_params=64 * 16).select("id", F.col("j").alias("i"), "v")
    probs = T.dense(hid, w2, b2, "softmax", n_params=160)
    dz = G.softmax_ce(probs, e.select(F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label")))
    return hid, dz, w2


@register(
    "grad_dense",
    f"""WITH {_mlp_logit_grad_sql()},
dw AS (SELECT 'W' AS param, i, j, sum(v * g) AS g FROM hid JOIN dz USING (id) GROUP BY i, j),
db AS (SELECT 'b' AS param, CAST(-1 AS BIGINT) AS i, j, sum(g) AS g FROM dz GROUP BY j)
SELECT param, i, CAST(j AS BIGINT) AS j, {R.format('g')} AS g FROM (SELECT * FROM dw UNION ALL SELECT * FROM db)""",
)
def q_grad_dense(spark, sf):
    hid, dz, w2 = _mlp_dense2_grads(spark, sf)
    dw, db, _ = G.dense_grads(hid, dz, w2)
    return dw.select(F.lit("W").alias("param"), "i", "j", r6("g").alias("g")).unionByName(
        db.select(F.lit("b").alias("param"), F.lit(-1).cast("bigint").alias("i"), "j", r6("g").alias("g"))
    )


@register(
    "grad_dense_input",
    f"""WITH {_mlp_logit_grad_sql()}
SELECT id, i, {R.format('sum(g * w)')} AS g FROM dz JOIN w2 USING (j) GROUP BY id, i""",
)
def q_grad_dense_input(spark, sf):
    hid, dz, w2 = _mlp_dense2_grads(spark, sf)
    _, _, dx = G.dense_grads(hid, dz, w2)
    return dx.select("id", "i", r6("g").alias("g"))


# Upstream gradients for the conv / pool / activation backward queries: the layer's own
# forward output stands in for dLoss/d(output) (any tensor of the right shape works).
@register(
    "grad_conv",
    f"""WITH {BASE},
gg AS (SELECT id, y AS oy, x AS ox, c AS f, v AS g FROM conv),
dw AS (SELECT 'W' AS param, f, c, dy, dx, sum(v * g) AS g FROM win JOIN gg USING (id, oy, ox) GROUP BY f, c, dy, dx),
db AS (SELECT 'b' AS param, f, CAST(-1 AS BIGINT) AS c, CAST(-1 AS BIGINT) AS dy, CAST(-1 AS BIGINT) AS dx, sum(g) AS g FROM gg GROUP BY f)
SELECT param, f, c, dy, dx, {R.format('g')} AS g FROM (SELECT * FROM dw UNION ALL SELECT * FROM db)""",
)
def q_grad_conv(spark, sf):
    wdf, _ = _conv_tables(spark)
    conv = _conv_out(spark, sf)
    dw, db, _ = G.conv_grads(_cells(spark, sf), conv.withColumnRenamed("v", "g"), wdf, 3, 3, 1, IMG_H, IMG_W)
    m1 = F.lit(-1).cast("bigint")
    return dw.select(F.lit("W").alias("param"), "f", "c", "dy", "dx", r6("g").alias("g")).unionByName(
        db.select(F.lit("b").alias("param"), "f", m1.alias("c"), m1.alias("dy"), m1.alias("dx"), r6("g").alias("g"))
    )


@register(
    "grad_conv_input",
    f"""WITH {BASE},
gg AS (SELECT id, y AS oy, x AS ox, c AS f, v AS g FROM conv)
SELECT id, oy + dy AS y, ox + dx AS x, c, {R.format('sum(g * w)')} AS g FROM gg JOIN wconv USING (f) GROUP BY id, oy + dy, ox + dx, c""",
)
def q_grad_conv_input(spark, sf):
    wdf, _ = _conv_tables(spark)
    conv = _conv_out(spark, sf)
    _, _, dx = G.conv_grads(_cells(spark, sf), conv.withColumnRenamed("v", "g"), wdf, 3, 3, 1, IMG_H, IMG_W)
    return dx.select("id", "y", "x", "c", r6("g").alias("g"))


@register(
    "grad_pool_avg",
    f"""WITH cells AS ({CELLS_SQL}), win AS ({_win_sql('cells', 3, 2, 8, 8)}),
pooled AS (SELECT id, oy, ox, c, sum(v) / 9.0 AS g FROM win GROUP BY id, oy, ox, c)
SELECT id, oy * 2 + dy AS y, ox * 2 + dx AS x, c, {R.format('sum(g / 9.0)')} AS g
FROM pooled, range(3) a(dy), range(3) b(dx) GROUP BY id, oy * 2 + dy, ox * 2 + dx, c""",
)
def q_grad_pool_avg(spark, sf):
    pooled = T.pool(_cells(spark, sf), 3, 2, IMG_H, IMG_W, "avg").withColumnRenamed("v", "g")
    return G.pool_avg_grad(pooled, 3, 2).select("id", "y", "x", "c", r6("g").alias("g"))


@register(
    "grad_pool_max",
    f"""WITH cells AS ({CELLS_SQL}), win AS ({_win_sql('cells', 3, 2, 8, 8)}),
pooled AS (SELECT id, oy, ox, c, max(v) AS m FROM win GROUP BY id, oy, ox, c)
SELECT id, oy * 2 + dy AS y, ox * 2 + dx AS x, c, {R.format('sum(m)')} AS g
FROM win JOIN pooled USING (id, oy, ox, c) WHERE v = m GROUP BY id, oy * 2 + dy, ox * 2 + dx, c""",
)
def q_grad_pool_max(spark, sf):
    cells = _cells(spark, sf)
    pooled = T.pool(cells, 3, 2, IMG_H, IMG_W, "max")
    g = pooled.withColumnRenamed("v", "g")
    return G.pool_max_grad(cells, pooled, g, 3, 2, IMG_H, IMG_W).select("id", "y", "x", "c", r6("g").alias("g"))


@register(
    "grad_act",
    f"""WITH {BASE}
SELECT id, y, x, c, {R.format('v * (1.0 - tanh(v) * tanh(v))')} AS g FROM conv""",
)
def q_grad_act(spark, sf):
    conv = _conv_out(spark, sf)
    return G.act_grad(conv, conv.withColumnRenamed("v", "g"), "tanh").select("id", "y", "x", "c", r6("g").alias("g"))
