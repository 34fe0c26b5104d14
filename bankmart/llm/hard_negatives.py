"""Hard-negative mining with rotated one-bit codes.

Vectors become integers ``floor(256 * x)``; a row's score is its integer inner product
with the anchor.  An anchor's positives are its best rows of the same label; its negatives,
for each positive, the best rows of another label whose score lies in a band of the
positive's score.

Every vector is turned by one random rotation and kept as a one-bit code (the signs
``c``, as a unit vector), with its alignment ``a = <x, c>`` and the length of what the
code leaves out, ``|x - a c|``.  An anchor is cut into eight bit planes, so ``<q, c>`` is
a sum of popcounts up to the known length of the cut's error.  As the rest of ``x`` is
orthogonal to ``c``, Cauchy-Schwarz gives ``<q, x>`` within ``a <q, c>`` plus or minus
``|x - a c| * sqrt(|q|^2 - <q, c>^2)``: an interval that always holds, not a probable
one.  A row stays a candidate only if its interval reaches the k-th best lower end found
(positives), or the band above the k-th best lower end that is surely in it (negatives);
only candidates are scored in integers, so results are exact.

Anchors against all rows run in blocks: rows and anchors are dealt by hash into blocks of
about ``block_rows`` and ``group_anchors``, each pair of blocks is solved in one task, and the k
best of each are merged.  Labels play no part in the dealing, so a hot label is spread.

Defined cases: rows with a null vec_id, label or vector, an empty vector, or a null or
non-finite component take no part; vectors of different length do not meet; repeated
vec_ids are rows of their own ("other" rows are told apart by row); ties go to the smaller
vec_id; a negative positive_score has an empty band; an empty table gives an empty
result; other columns are ignored.  Scores are 64-bit integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bankmart.llm.common import staged
from bankmart.llm.knn import inner

POSITIVES, NEGATIVES = 5, 10
ANCHOR_EVERY = 100
LOW, HIGH = 30, 90                      # per cent of the positive's score
PLANES = 8
SEED = 20240607
_ROTATION: dict[int, np.ndarray] = {}   # of the vector length last used
RESULT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def rotation(width: int) -> np.ndarray:
    if width not in _ROTATION:
        turn, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((width, width)))
        _ROTATION.clear()
        _ROTATION[width] = turn * np.sign(np.diag(r))
    return _ROTATION[width]


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    pad = -bits.shape[1] % 64
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1).view(np.uint64)


def encode(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, alignments and lengths of the rests of the vectors ``v``."""
    z = v.astype(np.float64) @ rotation(v.shape[1])
    align = np.abs(z).sum(1) / np.sqrt(v.shape[1])
    rest = np.sqrt(np.maximum(0, (z * z).sum(1) - align * align))
    return _packed(z > 0), align, rest


class Anchors:
    """Anchors cut into bit planes, for intervals of their scores."""

    def __init__(self, v: np.ndarray):
        self.width = v.shape[1]
        z = v.astype(np.float64) @ rotation(self.width)
        self.low = z.min(1)
        self.step = np.maximum((z.max(1) - self.low) / (2 ** PLANES - 1), 1e-300)
        cut = np.rint((z - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        back = self.low[:, None] + self.step[:, None] * cut
        self.error = np.linalg.norm(z - back, axis=1) * (1 + 1e-9)
        self.sum = back.sum(1)
        self.norm2 = (z * z).sum(1)
        self.planes = [_packed((cut >> j & 1).astype(bool)) for j in range(PLANES)]

    def intervals(self, code: np.ndarray, align: np.ndarray, rest: np.ndarray):
        """Lower and upper ends of all scores, anchors by rows."""
        ones = np.bitwise_count(code).sum(1, dtype=np.int64)
        dot = np.zeros((len(self.low), len(code)))
        for j, plane in enumerate(self.planes):
            count = np.zeros(dot.shape, np.int64)
            for w in range(code.shape[1]):
                count += np.bitwise_count(plane[:, w, None] & code[None, :, w])
            dot += count * float(1 << j)
        dot = self.low[:, None] * ones[None, :] + self.step[:, None] * dot
        t = (2 * dot - self.sum[:, None]) / np.sqrt(self.width)          # <q, c> but for the cut
        least = np.maximum(0, np.abs(t) - self.error[:, None])
        beside = np.sqrt(np.maximum(0, self.norm2[:, None] - least * least))
        half = align[None, :] * self.error[:, None] + rest[None, :] * beside
        half += 1e-9 * (np.sqrt(self.norm2)[:, None] * (align + rest)[None, :] + 1)
        middle = align[None, :] * t
        return middle - half, middle + half


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy())


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 8 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _positives_in(q: pd.DataFrame, d: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best rows of each anchor's label among one block's rows."""
    out = {c: [] for c in ("anchor", "row", "vec_id", "score")}
    of_label = d.groupby("label").indices
    for label, part in q.groupby("label"):
        if label not in of_label:
            continue
        rows = d.take(of_label[label])
        v, ids, place = _matrix(rows["v"]), rows["vec_id"].to_numpy(), rows["row"].to_numpy()
        code = np.stack([np.frombuffer(c, np.uint64) for c in rows["code"]])
        align, rest = rows["align"].to_numpy(), rows["rest"].to_numpy()
        qv, qrow = _matrix(part["v"]), part["row"].to_numpy()
        step = max(1, 1_000_000 // len(rows))
        for a in range(0, len(part), step):
            lower, upper = Anchors(qv[a:a + step]).intervals(code, align, rest)
            for i in range(len(lower)):
                other = place != qrow[a + i]
                low = np.where(other, lower[i], -np.inf)
                if len(low) > k:
                    other &= upper[i] >= np.partition(low, len(low) - k)[len(low) - k]
                left = np.flatnonzero(other)
                score = inner(qv[a + i:a + i + 1], v[left])[0]
                top = _best(score, ids[left], k)
                out["anchor"].append(np.full(len(top), qrow[a + i]))
                out["row"].append(place[left[top]])
                out["vec_id"].append(ids[left[top]])
                out["score"].append(score[top])
    return pd.DataFrame({c: np.concatenate(x) if x else np.empty(0, np.int64) for c, x in out.items()})


def _negatives_in(q: pd.DataFrame, d: pd.DataFrame, k: int, low: int, high: int) -> pd.DataFrame:
    """For each anchor and positive, the k best rows of other labels in the band."""
    out = {c: [] for c in ("anchor", "place", "row", "negative_id", "negative_score")}
    v, ids, place, label = _matrix(d["v"]), d["vec_id"].to_numpy(), d["row"].to_numpy(), d["label"].to_numpy()
    code = np.stack([np.frombuffer(c, np.uint64) for c in d["code"]])
    align, rest = d["align"].to_numpy(), d["rest"].to_numpy()
    qv, qrow, qlabel = _matrix(q["v"]), q["row"].to_numpy(), q["label"].to_numpy()
    step = max(1, 1_000_000 // len(d))
    for a in range(0, len(q), step):
        lower, upper = Anchors(qv[a:a + step]).intervals(code, align, rest)
        for i in range(len(lower)):
            other = label != qlabel[a + i]
            # whole scores in [30 p / 100, 90 p / 100]
            bands = [(-(-low * p // 100), high * p // 100) for p in q["scores"].iat[a + i]]
            wanted = np.zeros(len(d), bool)
            for lo, hi in set(bands):
                if lo > hi:
                    continue
                sure = lower[i][other & (lower[i] >= lo) & (upper[i] <= hi)]
                floor = np.partition(sure, len(sure) - k)[len(sure) - k] if len(sure) >= k else lo
                wanted |= other & (upper[i] >= max(lo, floor)) & (lower[i] <= hi)
            left = np.flatnonzero(wanted)
            score = inner(qv[a + i:a + i + 1], v[left])[0]
            for n, (lo, hi) in enumerate(bands):
                inside = np.flatnonzero((score >= lo) & (score <= hi))
                top = inside[_best(score[inside], ids[left[inside]], k)]
                out["anchor"].append(np.full(len(top), qrow[a + i]))
                out["place"].append(np.full(len(top), n + 1))
                out["row"].append(place[left[top]])
                out["negative_id"].append(ids[left[top]])
                out["negative_score"].append(score[top])
    return pd.DataFrame({c: np.concatenate(x) if x else np.empty(0, np.int64) for c, x in out.items()})


def coded(embeddings: DataFrame, label: Column) -> DataFrame:
    """Rows that take part: row, vec_id, label, v, width and the code's parts."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256.0).cast("long"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < float("inf")))
    rows = staged(
        embeddings.filter(F.col("vec_id").isNotNull() & label.isNotNull() & (F.size("embedding") > 0) & finite)
        .select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                whole.alias("v"), F.size("embedding").alias("width"))
        .withColumn("row", F.monotonically_increasing_id()), "negatives-vectors")

    def codes(frames):
        for f in frames:
            for _, part in f.groupby("width"):
                code, align, rest = encode(_matrix(part["v"]))
                yield part.assign(code=[c.tobytes() for c in code], align=align, rest=rest)

    return staged(rows.mapInPandas(
        codes, "vec_id long, label long, v array<long>, width int, row long, code binary, align double, rest double"),
        "negatives-codes")


def mine(embeddings: DataFrame, anchors: Column | None = None, label: Column | None = None,
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         block_rows: int = 8192, group_anchors: int = 1024) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``
    for the rows that ``anchors`` marks (a condition on vec_id and label)."""
    if anchors is None:
        anchors = F.col("vec_id") % ANCHOR_EVERY == 0
    rows = coded(embeddings, F.col("label") if label is None else label)
    n, n_anchors = rows.agg(F.count("*"), F.count(F.when(anchors, 1))).first()
    blocks, groups = max(1, -(-n // block_rows)), max(1, -(-n_anchors // group_anchors))

    def every(count):
        return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))

    data = (rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
            .withColumn("grp", F.explode(every(groups))))
    chosen = rows.filter(anchors).select("row", "vec_id", "label", "v", "width")

    def dealt(asked):
        """Each anchor to its group, once for each block of rows."""
        return (asked.withColumn("grp", F.pmod(F.xxhash64("row"), F.lit(groups)))
                .withColumn("block", F.explode(every(blocks))).toDF(*asked.columns, "grp", "block"))

    def solved(asked, solve, schema):
        none = [x.split()[0] for x in schema.split(", ")]

        def cell(key, q, d):
            if not len(q) or not len(d):
                return pd.DataFrame({c: [] for c in none}, dtype="int64")
            return solve(q, d)

        return (dealt(asked).groupBy("width", "grp", "block").cogroup(data.groupBy("width", "grp", "block"))
                .applyInPandas(cell, schema))

    by_score = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row")
    found = staged(
        solved(chosen, lambda q, d: _positives_in(q, d, positives), "anchor long, row long, vec_id long, score long")
        .withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= positives), "negatives-positives")
    # at most `positives` entries a list
    lists = found.groupBy("anchor").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x["score"]).alias("scores"))
    asked = chosen.join(lists, chosen["row"] == lists["anchor"]).drop("anchor")
    per_pair = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id", "row")
    best = (solved(asked, lambda q, d: _negatives_in(q, d, negatives, low, high),
                   "anchor long, place int, row long, negative_id long, negative_score long")
            .withColumn("rank", F.row_number().over(per_pair)).filter(F.col("rank") <= negatives).drop("row"))
    named = found.select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = chosen.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return best.join(named, ["anchor", "place"]).join(ids, "anchor").select(*RESULT)


def op12(spark, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label=moved)


OP12_SQL = f"""
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(cast(x as double) * 256)) as v
  from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
scored as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
    cast(list_dot_product(a.v, b.v) as bigint) as score
  from e a join e b on a.vec_id % {ANCHOR_EVERY} = 0 and a.vec_id <> b.vec_id and len(a.v) = len(b.v)),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= {POSITIVES})
select anchor_id, positive_id,
  cast(row_number() over (partition by anchor_id, positive_id order by score desc, other_id) as integer) as rank,
  other_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and {LOW} * positive_score <= 100 * score and 100 * score <= {HIGH} * positive_score
qualify rank <= {NEGATIVES}"""
