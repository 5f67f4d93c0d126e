"""Document quality by co-training: one classifier sees the text, one the page's metadata."""

from __future__ import annotations

import operator
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playstar.llm.common import session_of
from playstar.session import new_folder, store

#: Bound of the sample of labelled documents that the classifiers are fitted on. Pseudo-labels are sought in all other rows.
SAMPLE_LABELLED = 4000
#: Rounds in which each classifier labels documents for the other one, and how sure it has to be.
ROUNDS = 3
SURE = 0.97
#: Pseudo-labels given of each kind in a round, at most, and their weight.
GIVEN = 400
PSEUDO_WEIGHT = 0.5
#: Pieces in which the surest rows of all tasks are merged first.
MERGED_BY = 256
#: Places that the values of a metadata column are hashed to.
PLACES = 32

METADATA = ("lang", "source", "n_chars")

UPPER, LOWER, DIGIT, SPACE, BREAK, ENDING, SYMBOL = range(7)


def _kinds() -> np.ndarray:
    """Kind of each byte of UTF-8; those beyond ASCII count as lower case letters."""
    kinds = np.full(256, LOWER, np.uint8)
    kinds[:128] = SYMBOL
    for kind, chars in ((UPPER, range(65, 91)), (LOWER, range(97, 123)), (DIGIT, range(48, 58)), (SPACE, (9, 11, 12, 13, 32)), (BREAK, (10,))):
        kinds[list(chars)] = kind
    kinds[[ord(c) for c in ".,;:'\"-()?"]] = ENDING
    return kinds


KINDS = _kinds()
LINE_BYTES = 20


def text_features(text: str) -> list[float]:
    """Shares of capitals, symbols, digits and endings, of the whole and of the worst line; repeats of words and lines; lengths."""
    words = text.split()
    if not words:
        return [0.0] * 12
    kinds = KINDS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    counts = np.bincount(kinds, minlength=7)
    letters = max(1, counts[UPPER] + counts[LOWER])
    solid = max(1, len(kinds) - counts[SPACE] - counts[BREAK])
    starts = np.concatenate(([0], np.flatnonzero(kinds == BREAK) + 1))
    starts = starts[starts < len(kinds)]
    lengths = np.diff(np.append(starts, len(kinds)))
    upper, symbol, letter = (np.add.reduceat(m.astype(np.int32), starts) for m in (kinds == UPPER, kinds == SYMBOL, kinds <= LOWER))
    long = lengths >= LINE_BYTES
    worst = lambda part, whole: float((part[long] / np.maximum(whole[long], 1)).max()) if long.any() else 0.0
    lines = text.split("\n")
    repeats = sum(map(operator.eq, words, words[1:]))
    return [
        counts[UPPER] / letters,
        counts[SYMBOL] / solid,
        counts[DIGIT] / solid,
        counts[ENDING] / solid,
        worst(upper, letter),
        worst(symbol, lengths),
        repeats / len(words),
        min(1.0, repeats / 5),
        1 - len(set(lines)) / len(lines),
        float(np.log(len(set(words))) / np.log(len(words) + 1)),
        solid / len(words) / 10,
        float(np.log1p(len(words))) / 10,
    ]


def page_features(values: list) -> list[float]:
    """A hashed place for each text, size and presence of each number; nulls are values of their own."""
    out: list[float] = []
    for value in values:
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            finite = bool(np.isfinite(value))
            out += [0.0] * PLACES + [float(np.sign(value) * np.log1p(abs(value))) / 10 if finite else 0.0, float(finite)]
        else:
            place = [0.0] * PLACES
            if value is not None:
                place[zlib.crc32(str(value).encode("utf-8", "surrogatepass")) % PLACES] = 1.0
            out += [*place, 0.0, 0.0]
    return out


@dataclass
class View:
    """A logistic classifier on standardized features, and the line that calibrates its log-odds."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -4, 4) @ self.weights[:-1] + self.weights[-1]

    def logit(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.raw(rows) + self.shift, -30, 30)


@dataclass
class Model:
    """Views and the weights that combine their calibrated log-odds; without views every score is ``share``."""

    text: View | None
    page: View | None
    combine: np.ndarray
    share: float = 1.0

    def scores(self, text: np.ndarray, page: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.text is None:
            return (np.full(len(text), self.share),) * 3
        a, b = self.text.logit(text), self.page.logit(page)
        return _odds(self.combine[0] * a + self.combine[1] * b + self.combine[2]), _odds(a), _odds(b)


def _odds(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def logistic(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Weights and bias (last) by Newton steps; ``ridge`` does not touch the bias."""
    x = np.hstack([rows, np.ones((len(rows), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _odds(x @ w)
        slope = x.T @ (weight * (p - labels)) + penalty * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _view(rows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> View:
    mean, scale = rows.mean(0), rows.std(0)
    scale[scale < 1e-9] = 1.0
    return View(mean, scale, logistic(np.clip((rows - mean) / scale, -4, 4), labels, weight, ridge=1.0))


@dataclass
class Given:
    """Pseudo-labels of a round by one view: keys of rows, labels, and what the other view sees of them."""

    keys: np.ndarray
    kinds: np.ndarray
    rows: np.ndarray


#: From both views and the keys each has labelled before, the rows each is surest of now.
Surest = Callable[[list[View], list[np.ndarray]], list[Given]]


def best(sure: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the GIVEN rows at most of SURE or more, the surest first; ties by id, then key."""
    enough = np.flatnonzero(sure >= SURE)
    return enough[np.lexsort((keys[enough], ids[enough], -sure[enough]))][:GIVEN]


def among(text: np.ndarray, page: np.ndarray) -> Surest:
    """`Surest` of rows in memory, whose keys are their places."""
    views, keys = (text, page), np.arange(len(text))

    def surest(models: list[View], taken: list[np.ndarray]) -> list[Given]:
        out = []
        for v, model in enumerate(models):
            free = np.setdiff1d(keys, taken[v])
            p = _odds(model.logit(views[v][free]))
            chosen = [free[best(sure, free, free)] for sure in (p, 1 - p)]
            kinds = np.repeat([1.0, 0.0], [len(c) for c in chosen])
            out.append(Given(np.concatenate(chosen), kinds, views[1 - v][np.concatenate(chosen)]))
        return out

    return surest


def cotrain(text: np.ndarray, page: np.ndarray, labels: np.ndarray, surest: Surest | None = None) -> Model:
    """``labels``: 1 good, 0 bad, -1 none. A quarter of the labelled rows is kept to calibrate and combine the views.

    In each round both views are fitted on the labels and the pseudo-labels that the other view has given
    them; then each view, calibrated, labels the rows it is surest of (SURE at least) for the other. These come from
    ``surest``, or are the rows without a label.
    """
    known = np.flatnonzero(labels >= 0)
    if len(known) < 8 or labels[known].min() == labels[known].max():
        return Model(None, None, np.zeros(3), float(labels[known].mean()) if len(known) else 1.0)
    kept = known[3::4]
    fitted = np.setdiff1d(known, kept)
    if any(labels[part].min() == labels[part].max() for part in (kept, fitted)):
        kept = fitted = known
    views = (text, page)
    if surest is None:
        surest = among(text[labels < 0], page[labels < 0])
    given: list[list[Given]] = [[], []]  # by a view
    for turn in range(ROUNDS + 1):
        models = []
        for v, rows in enumerate(views):
            extra = given[1 - v]
            target = np.concatenate([labels[fitted], *(g.kinds for g in extra)])
            weight = np.where(np.arange(len(target)) < len(fitted), 1.0, PSEUDO_WEIGHT)
            model = _view(np.concatenate([rows[fitted], *(g.rows for g in extra)]), target, weight)
            line = logistic(model.raw(rows[kept])[:, None], labels[kept].astype(float), np.ones(len(kept)), ridge=0.1)
            model.slope, model.shift = max(0.0, float(line[0])), float(line[1])
            models.append(model)
        if turn == ROUNDS:
            break
        found = surest(models, [np.concatenate([np.zeros(0, np.int64), *(g.keys for g in of)]) for of in given])
        if not any(len(g.keys) for g in found):
            break
        for of, new in zip(given, found, strict=True):
            of.append(new)
    logits = np.column_stack([model.logit(rows[kept]) for rows, model in zip(views, models, strict=True)])
    return Model(*models, logistic(logits, labels[kept].astype(float), np.ones(len(kept)), ridge=0.1))


def _pages(metadata: list[pa.Array], count: int) -> np.ndarray:
    values = zip(*(column.to_pylist() for column in metadata), strict=True) if metadata else ([] for _ in range(count))
    return np.array([page_features(list(row)) for row in values], float).reshape(count, -1)


def _text_rows(texts: pa.Array) -> np.ndarray:
    return np.array([text_features(t.as_py() or "") for t in texts], float).reshape(len(texts), -1)


def _both(batch: pa.RecordBatch | pa.Table) -> list[np.ndarray]:
    """What the views see of rows of ``key``, ``doc_id``, text features and metadata."""
    text = np.array(batch.column(2).to_pylist(), float).reshape(batch.num_rows, -1)
    return [text, _pages(batch.columns[3:], batch.num_rows)]


def _surest_rows(rows: DataFrame, *group: str) -> DataFrame:
    """The GIVEN rows of each group that `best` would take."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("sure"), "doc_id", "key"))
    return rows.withColumn("place", place).where(F.col("place") <= GIVEN).drop("place")


def among_all(others: DataFrame) -> Surest:
    """`Surest` of a stored table, scored by Spark tasks. A task gives ids of GIVEN rows at most of each kind and view."""

    def surest(models: list[View], taken: list[np.ndarray]) -> list[Given]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = {(v, kind): np.zeros(0) for v in (0, 1) for kind in (1, 0)}
            ids = {at: np.zeros((2, 0), np.int64) for at in held}
            for batch in batches:
                if not batch.num_rows:
                    continue
                here = np.array([batch.column(0).to_numpy(), batch.column(1).fill_null(np.iinfo(np.int64).min).to_numpy()])
                for v, (model, rows) in enumerate(zip(models, _both(batch), strict=True)):
                    free = ~np.isin(here[0], taken[v])
                    p = _odds(model.logit(rows[free]))
                    for kind, sure in ((1, p), (0, 1 - p)):
                        sure = np.concatenate([held[v, kind], sure])
                        both = np.concatenate([ids[v, kind], here[:, free]], axis=1)
                        top = best(sure, both[1], both[0])
                        held[v, kind], ids[v, kind] = sure[top], both[:, top]
            for (v, kind), sure in held.items():
                n = len(sure)
                columns = [pa.array([v] * n, pa.int32()), pa.array([kind] * n, pa.int32()), *map(pa.array, ids[v, kind]), pa.array(sure)]
                yield pa.RecordBatch.from_arrays(columns, ["view", "kind", "key", "doc_id", "sure"])

        surest_of_tasks = others.mapInArrow(run, "view int, kind int, key long, doc_id long, sure double")
        # Merged in two steps, so that neither one task nor the driver gets the rows of all tasks.
        pieces = surest_of_tasks.withColumn("piece", F.pmod(F.xxhash64("key"), F.lit(MERGED_BY)))
        found = _surest_rows(_surest_rows(pieces, "view", "kind", "piece"), "view", "kind").drop("piece").toArrow()
        view, kind, keys, ids, sure = (column.to_numpy() for column in found.columns)
        chosen = {}
        for v in (0, 1):
            for k in (1, 0):
                at = np.flatnonzero((view == v) & (kind == k))
                chosen[v, k] = keys[at[best(sure[at], ids[at], keys[at])]]
        wanted = sorted({int(key) for part in chosen.values() for key in part})
        if not wanted:
            return [Given(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, len(models[1 - v].mean)))) for v in (0, 1)]
        rows = others.where(F.col("key").isin(wanted)).toArrow()
        place = {key: i for i, key in enumerate(rows.column(0).to_pylist())}
        seen = _both(rows)
        out = []
        for v in (0, 1):
            of = np.concatenate([chosen[v, 1], chosen[v, 0]])
            out.append(Given(of, np.repeat([1.0, 0.0], [len(chosen[v, 1]), len(chosen[v, 0])]), seen[1 - v][[place[int(k)] for k in of]]))
        return out

    return surest


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", metadata: tuple[str, ...] = METADATA, label: str = "quality"
) -> Model:
    """The classifiers of SAMPLE_LABELLED labelled documents, drawn by the hash of their ids, and of pseudo-labels on all other rows.

    An id with several labels counts as bad if one says so. Null ids and labels that are not 0 or 1 are left out.
    Rows outside the sample count as unlabelled, also those with a label or without an id. Their features are written once and
    scored in each round. Without labels of both kinds, every document gets the share of good labels (1 without any).
    """
    return _trained(_stored_features(docs, doc_id, text, metadata), labels, doc_id, label)


def _stored_features(docs: DataFrame, doc_id: str, text: str, metadata: tuple[str, ...]) -> DataFrame:
    """``key``, ``doc_id``, text features (``text``) and metadata (``m0``, ``m1`` ...) of every row, written once."""
    spark = session_of(docs)

    @F.arrow_udf("array<double>")
    def read(texts: pa.Array) -> pa.Array:
        return pa.array([text_features(t.as_py() or "") for t in texts], pa.list_(pa.float64()))

    values = [F.col(c).cast("string") if kind == "void" else F.col(c) for c in metadata for kind in [dict(docs.dtypes).get(c)]]
    return store(
        docs.select(
            F.monotonically_increasing_id().alias("key"),
            F.col(doc_id).cast("long").alias("doc_id"),
            read(F.col(text).cast("string")).alias("text"),
            *(value.alias(f"m{i}") for i, value in enumerate(values)),
        ),
        new_folder(spark, "features"),
    )


def _trained(features: DataFrame, labels: DataFrame, doc_id: str, label: str) -> Model:
    spark = features.sparkSession
    marked = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("mark"))
    marked = marked.where("doc_id is not null and mark in (0, 1)").groupBy("doc_id").agg(F.min("mark").alias("mark"))
    drawn = store(marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_LABELLED), new_folder(spark, "labelled"))

    @F.arrow_udf("array<double>")
    def seen(first: pa.Array, *columns: pa.Array) -> pa.Array:
        return pa.array(list(_pages(list(columns), len(first))), pa.list_(pa.float64()))

    sample = (
        features.join(F.broadcast(drawn), "doc_id")
        .select("doc_id", "mark", F.struct("text", seen("key", *features.columns[3:]).alias("page")).alias("found"))
        .groupBy("doc_id")
        .agg(F.first("mark").alias("mark"), F.min("found").alias("found"))
        .collect()
    )
    if not sample:
        return Model(None, None, np.zeros(3))
    sample.sort(key=lambda r: r["doc_id"])
    sides = (np.array([r["found"][side] for r in sample], float) for side in ("text", "page"))
    others = features.join(F.broadcast(drawn.select("doc_id")), "doc_id", "left_anti").select(features.columns)
    return cotrain(*sides, np.array([r["mark"] for r in sample]), among_all(others))


SCORES = "struct<score: double, text_score: double, page_score: double>"


def _scores(model: Model, text: Callable[[], np.ndarray], rows: pa.Array, metadata: tuple[pa.Array, ...]) -> pa.Array:
    both = model.scores(text(), _pages(list(metadata), len(rows))) if len(rows) else (np.zeros(0),) * 3
    return pa.StructArray.from_arrays([pa.array(s) for s in both], ["score", "text_score", "page_score"])


def _judged(rows: DataFrame, threshold: float) -> DataFrame:
    return rows.select("doc_id", "found.*").withColumn("keep", F.col("score") >= threshold)


def quality(text: Column, metadata: list[Column], model: Model) -> Column:
    """A struct of the combined ``score`` (0 to 1, higher is better) and those of the two views.

    Whole texts. Null and empty texts have the features of an empty text; null metadata are a value of their own.
    """

    @F.arrow_udf(SCORES)
    def scored(texts: pa.Array, *columns: pa.Array) -> pa.Array:
        return _scores(model, lambda: _text_rows(texts), texts, columns)

    return scored(text.cast("string"), *metadata)


def score(
    docs: DataFrame, model: Model, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text", metadata: tuple[str, ...] = METADATA
) -> DataFrame:
    """``doc_id``, ``score``, ``text_score``, ``page_score`` and ``keep`` (score of ``threshold`` or more) of every row.

    Repeated rows and ids, and null ids, each give their row. Other columns are ignored; an empty table gives an empty one. No shuffle.
    """
    session_of(docs)
    found = quality(F.col(text), [F.col(c) for c in metadata], model)
    return _judged(docs.select(F.col(doc_id).cast("long").alias("doc_id"), found.alias("found")), threshold)


def train_and_score(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.5,
    doc_id: str = "doc_id",
    text: str = "text",
    metadata: tuple[str, ...] = METADATA,
    label: str = "quality",
) -> DataFrame:
    """What ``score(docs, train(docs, labels))`` gives, from one reading of the texts: their stored features are scored."""
    features = _stored_features(docs, doc_id, text, metadata)
    model = _trained(features, labels, doc_id, label)

    @F.arrow_udf(SCORES)
    def scored(texts: pa.Array, *columns: pa.Array) -> pa.Array:
        return _scores(model, lambda: np.array(texts.to_pylist(), float).reshape(len(texts), -1), texts, columns)

    found = scored("text", *features.columns[3:])
    return _judged(features.select("doc_id", found.alias("found")), threshold)
