"""Feature preparation: impute, scale and encode, fitted on training rows and applied to any rows.

What is fitted is a handful of numbers per column and the category
dictionaries (their size is checked). Applying it is one projection of SQL
expressions, so it fuses with the scan and saves as a ``SQLTransformer``.

With folds, the numbers of every training set come out of the same passes:
each row is counted once, for its own fold, and sets are put together from folds.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.operators.fold_statistics import Moments, fold_moments, medians_and_quartiles, number

SCALERS = ("standard", "minmax", "robust")
ENCODERS = ("onehot", "ordinal", "target")
MAX_CATEGORIES = 100_000
MAX_COUNTS = 2_000_000  # numbers per fold, category, class and inner fold that one fit brings to the driver
MAX_INLINE = 500
MAX_DENSE = 128  # numbers of a one-hot vector that is written out; longer ones are sparse
INNER_FOLDS = 5
WHOLE = -1


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


@dataclass
class TrainingStats:
    """Everything any scaler or encoder needs to know about one training set."""

    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    moments: dict[str, tuple[float, float, float, float]] = field(default_factory=dict)
    quartiles: dict[str, tuple[float, float, float]] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    classes: list = field(default_factory=list)
    class_counts: dict[tuple[str, str, int], dict] = field(default_factory=dict)
    dropped: list[str] = field(default_factory=list)

    def prep(self, scaler: str = "robust", encoder: str = "onehot") -> "FittedPrep":
        return FittedPrep(self, *check_names(scaler, encoder))


def check_names(scaler: str, encoder: str) -> tuple[str, str]:
    scaler, encoder = scaler.lower(), encoder.lower()
    if scaler not in SCALERS:
        raise ValueError(f"unknown scaler: {scaler}")
    if encoder not in ENCODERS:
        raise ValueError(f"unknown encoder: {encoder}")
    return scaler, encoder


@dataclass
class FittedPrep:
    """One scaler and one encoder over fitted statistics."""

    stats: TrainingStats
    scaler: str
    encoder: str

    def numeric_expressions(self, scaled: bool = True) -> dict[str, str]:
        found = {}
        for c in self.stats.numeric:
            filled = f"coalesce(CAST({_name(c)} AS DOUBLE), {_number(self.stats.medians[c])})"
            if scaled:
                centre, width = self.centre_and_width(c)
                filled = f"({filled} - {_number(centre)}) / {_number(width)}"
            found[c] = filled
        return found

    def centre_and_width(self, column: str) -> tuple[float, float]:
        """A width of zero scales by one, so a constant column becomes zeros."""
        mean, std, low, high = self.stats.moments[column]
        if self.scaler == "standard":
            # a constant column may leave rounding noise behind
            return mean, std if std > 10 * 2.220446049250313e-16 * max(abs(mean), std) else 1.0
        if self.scaler == "minmax":
            return low, (high - low) or 1.0
        q1, median, q3 = self.stats.quartiles[column]
        return median, (q3 - q1) or 1.0

    def imputed_category(self, column: str) -> str:
        return f"coalesce({_name(column)}, {_text(self.stats.modes[column])})"

    def encoded_expressions(self) -> dict[str, str]:
        """Encoded columns for rows outside the training set."""
        found = {}
        for c in self.stats.categorical:
            value, known = self.imputed_category(c), self.stats.categories[c]
            if self.encoder == "onehot":
                found |= {f"{c}_{v}": f"CAST({value} = {_text(v)} AS DOUBLE)" for v in known}
            elif self.encoder == "ordinal":
                self._check_inline(c)
                listed = ", ".join(_text(v) for v in known)
                found[c] = f"CAST(array_position(array({listed}), {value}) - 1 AS DOUBLE)"
            else:
                self._check_inline(c)
                table = self.target_table(c, WHOLE)
                overall = self.overall_means(WHOLE)
                for i, k in enumerate(self.stats.classes):
                    pairs = ", ".join(f"{_text(v)}, {_number(means[i])}" for v, means in table.items())
                    found[f"{c}_{k}"] = f"coalesce(element_at(map({pairs}), {value}), {_number(overall[i])})"
        return found

    def _check_inline(self, column: str) -> None:
        if len(self.stats.categories[column]) > MAX_INLINE:
            raise ValueError(f"{column} has more than {MAX_INLINE} categories for one expression; use transform()")

    def _totals(self, inner: int) -> dict:
        totals = dict.fromkeys(self.stats.classes, 0)
        first = self.stats.categorical[0]
        for v in self.stats.categories[first]:
            for k, n in self._counts(first, v, inner).items():
                totals[k] += n
        return totals

    def _counts(self, column: str, value: str, inner: int) -> dict:
        """Class counts of a category over the training rows, those of inner fold ``inner`` left out."""
        counts = dict.fromkeys(self.stats.classes, 0)
        for i in range(INNER_FOLDS):
            if i != inner:
                for k, n in self.stats.class_counts.get((column, value, i), {}).items():
                    counts[k] += n
        return counts

    def overall_means(self, inner: int) -> list[float]:
        totals = self._totals(inner)
        rows = sum(totals.values())
        return [totals[k] / rows if rows else 0.0 for k in self.stats.classes]

    def target_table(self, column: str, inner: int) -> dict[str, list[float]]:
        """Per category and class: its mean, pulled to the overall mean the more its rows vary and the fewer they are."""
        overall = self.overall_means(inner)
        table = {}
        for v in self.stats.categories[column]:
            counts = self._counts(column, v, inner)
            n = sum(counts.values())
            means = []
            for k, base in zip(self.stats.classes, overall):
                spread = base * (1 - base)
                if n == 0 or spread == 0:
                    means.append(base)
                    continue
                own = counts[k] / n
                weight = n / (n + own * (1 - own) / spread)
                means.append(weight * own + (1 - weight) * base)
            if n:
                table[v] = means
        return table

    def output_columns(self) -> list[str]:
        if self.encoder == "ordinal":
            return [*self.stats.numeric, *self.stats.categorical]
        tails = (
            [(c, v) for c in self.stats.categorical for v in self.stats.categories[c]]
            if self.encoder == "onehot"
            else [(c, k) for c in self.stats.categorical for k in self.stats.classes]
        )
        return [*self.stats.numeric, *[f"{c}_{t}" for c, t in tails]]

    def transform(self, df: DataFrame, keep: Sequence[str] = (), inner: Column | None = None) -> DataFrame:
        """Scaled numbers and encoded categories, next to the columns in ``keep``.

        ``inner`` gives training rows their inner fold (-1 for other rows), so
        that a target encoding never sees the row's own label.
        """
        numbers = [F.expr(e).alias(c) for c, e in self.numeric_expressions().items()]
        wide = any(len(v) > MAX_INLINE for v in self.stats.categories.values())
        if (self.encoder == "target" and inner is not None) or (wide and self.encoder != "onehot"):
            return self._looked_up(df, keep, numbers, F.lit(WHOLE) if inner is None else inner)
        encoded = [F.expr(e).alias(c) for c, e in self.encoded_expressions().items()]
        return df.select(*keep, *numbers, *encoded)

    def _looked_up(self, df: DataFrame, keep: Sequence[str], numbers: list[Column], inner: Column) -> DataFrame:
        """Dictionary lookups as joins with tables of at most MAX_CATEGORIES * (INNER_FOLDS + 1) rows."""
        spark, joined, encoded = df.sparkSession, df.withColumn("__inner", inner.cast("int")), []
        for i, c in enumerate(self.stats.categorical):
            value, width = f"__value_{i}", len(self.stats.classes) if self.encoder == "target" else 1
            if self.encoder == "target":
                folds = range(WHOLE, INNER_FOLDS)
                rows = [(v, f, m) for f in folds for v, m in self.target_table(c, f).items()]
                unseen = F.get(
                    F.array(*[F.array(*[F.lit(m) for m in self.overall_means(f)]) for f in folds]), F.col("__inner") + 1
                )
            else:
                rows = [(v, WHOLE, [float(code)]) for code, v in enumerate(self.stats.categories[c])]
                unseen = F.array(F.lit(-1.0))
            schema = f"{value} string, __inner int, __code_{i} array<double>"
            table = spark.createDataFrame(rows, schema)
            joined = joined.withColumn(value, F.expr(self.imputed_category(c)))
            if self.encoder == "target":
                joined = joined.join(F.broadcast(table), [value, "__inner"], "left")
            else:
                joined = joined.join(F.broadcast(table.drop("__inner")), value, "left")
            code = F.coalesce(F.col(f"__code_{i}"), unseen)
            names = [f"{c}_{k}" for k in self.stats.classes] if self.encoder == "target" else [c]
            encoded += [F.get(code, F.lit(j)).alias(n) for j, n in zip(range(width), names)]
        return joined.select(*keep, *numbers, *encoded)

    def _one_hot_stages(self, output: str, spark: SparkSession) -> list:
        """Numbers by projection, categories by a dictionary lookup and a sparse vector: the same for any number of them."""
        numbers = [f"__f{i}" for i in range(len(self.stats.numeric))]
        texts = [f"__c{i}" for i in range(len(self.stats.categorical))]
        parts = [*self.numeric_expressions().values(), *map(self.imputed_category, self.stats.categorical)]
        listed = ", ".join(f"{e} AS {n}" for e, n in zip(parts, numbers + texts))
        stages: list = [SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__")]
        for c, text in zip(self.stats.categorical, texts):
            # a value that training did not have gets the number after the last, which the encoder leaves out
            stages.append(StringIndexerModel.from_labels(self.stats.categories[c], text, f"{text}_at", handleInvalid="keep"))
        if texts:
            sizes = [len(self.stats.categories[c]) + 1 for c in self.stats.categorical]
            encoder = OneHotEncoder(inputCols=[f"{t}_at" for t in texts], outputCols=[f"{t}_bits" for t in texts], dropLast=True)
            # fitting only learns the sizes: one row with the last number of each column says them all
            stages.append(encoder.fit(spark.createDataFrame([tuple(float(n - 1) for n in sizes)], [f"{t}_at" for t in texts])))
        stages.append(VectorAssembler(inputCols=[*numbers, *[f"{t}_bits" for t in texts]], outputCol=output))
        return stages

    def stages(self, output: str = "features") -> list:
        """The same preparation as saveable pipeline stages, for rows outside the training set."""
        if self.encoder == "onehot":
            return self._one_hot_stages(output, SparkSession.builder.getOrCreate())
        names = [f"__f{i}" for i in range(len(self.output_columns()))]
        parts = [*self.numeric_expressions().values(), *self.encoded_expressions().values()]
        listed = ", ".join(f"{e} AS {n}" for e, n in zip(parts, names))
        return [
            SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__"),
            VectorAssembler(inputCols=names, outputCol=output),
        ]

    def vectors(self, df: DataFrame, keep: Sequence[str], output: str = "features", inner: Column | None = None) -> DataFrame:
        """``keep`` and one feature vector per row, as stages() and transform() give it.

        The fitted numbers travel to the tasks as arrays and rows as Arrow columns: the plan is the same for every scaler, encoder
        and training set, so nothing is compiled anew for each.
        """
        numeric, categorical = self.stats.numeric, self.stats.categorical
        parts = [*[F.col(_name(c)).cast("double").alias(f"__f{i}") for i, c in enumerate(numeric)], *[F.col(_name(c)).cast("string").alias(f"__c{i}") for i, c in enumerate(categorical)]]
        own = F.lit(WHOLE) if inner is None or self.encoder != "target" else inner
        kept = df.select(*keep).schema.fields
        made = _vector_maker(self, len(kept), [f.name for f in kept] + [output])
        return df.select(*keep, *parts, own.cast("int").alias("__inner")).mapInArrow(made, T.StructType([*kept, T.StructField(output, VectorUDT())]))


def _vector_maker(prep: FittedPrep, kept: int, names: list[str]):
    """What makes vectors of batches of ``kept`` columns, numbers, texts and the inner fold."""
    stats, encoder = prep.stats, prep.encoder
    medians = [float(stats.medians[c]) for c in stats.numeric]
    centres, widths = (np.array(v, float) for v in (zip(*map(prep.centre_and_width, stats.numeric)) if stats.numeric else ((), ())))
    modes = [stats.modes[c] for c in stats.categorical]
    known = [pa.array(stats.categories[c], pa.string()) for c in stats.categorical]
    first, numbers, classes = WHOLE, len(medians), len(stats.classes)
    if encoder == "onehot":
        starts = numbers + np.cumsum([0, *map(len, known)])
        width = int(starts[-1])
    else:
        width = numbers + len(known) * (1 if encoder == "ordinal" else classes)
    means: list[np.ndarray] = []
    if encoder == "target" and known:
        folds = range(WHOLE, INNER_FOLDS)
        overall = {f: prep.overall_means(f) for f in folds}
        for c in stats.categorical:
            tables = {f: prep.target_table(c, f) for f in folds}
            # the last place is that of values that training did not have
            means.append(np.array([[tables[f].get(v, overall[f]) for v in stats.categories[c]] + [overall[f]] for f in folds], float))

    def codes(batch: pa.RecordBatch, i: int) -> np.ndarray:
        """The place of each row's category, -1 for one that training did not have."""
        text = pc.fill_null(batch.column(kept + numbers + i), modes[i])
        return pc.fill_null(pc.index_in(text, value_set=known[i].cast(text.type)), -1).to_numpy().astype(np.int64)

    def dense(batch: pa.RecordBatch, scaled: np.ndarray) -> pa.StructArray:
        n = len(scaled)
        out = np.zeros((n, width))
        out[:, :numbers] = scaled
        for i in range(len(known)):
            code = codes(batch, i)
            if encoder == "onehot":
                seen = np.flatnonzero(code >= 0)
                out[seen, starts[i] + code[seen]] = 1.0
            elif encoder == "ordinal":
                out[:, numbers + i] = code
            else:
                inner = batch.column(batch.num_columns - 1).to_numpy()
                out[:, numbers + i * classes : numbers + (i + 1) * classes] = means[i][inner - first, code]
        ends = np.arange(n + 1, dtype=np.int32) * width
        none = pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, np.int32)), pa.array([], pa.int32()), mask=pa.array(np.ones(n, bool)))
        values = pa.ListArray.from_arrays(pa.array(ends), pa.array(out.reshape(-1)))
        empty = pa.nulls(n, pa.int32())
        return pa.StructArray.from_arrays([pa.array(np.ones(n, np.int8)), empty, none, values], ["type", "size", "indices", "values"])

    def sparse(batch: pa.RecordBatch, scaled: np.ndarray) -> pa.StructArray:
        n = len(scaled)
        code = np.stack([codes(batch, i) for i in range(len(known))], axis=1)
        place = np.concatenate([np.broadcast_to(np.arange(numbers), scaled.shape), starts[:-1] + code], axis=1)
        value = np.concatenate([scaled, np.ones(code.shape)], axis=1)
        seen = np.concatenate([scaled != 0, code >= 0], axis=1)
        ends = pa.array(np.concatenate([[0], np.cumsum(seen.sum(axis=1))]).astype(np.int32))
        indices, values = pa.ListArray.from_arrays(ends, pa.array(place[seen].astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(value[seen]))
        return pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, width, np.int32)), indices, values], ["type", "size", "indices", "values"])

    few = encoder != "onehot" or width <= MAX_DENSE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = np.empty((batch.num_rows, numbers))
            for i, median in enumerate(medians):
                scaled[:, i] = (pc.fill_null(batch.column(kept + i), median).to_numpy() - centres[i]) / widths[i]
            vectors = dense(batch, scaled) if few else sparse(batch, scaled)
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], vectors], names)

    return run


def fit_stats(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    label: str | None = None,
    folds: int | None = None,
    scalers: Sequence[str] = SCALERS,
) -> dict[int, TrainingStats]:
    """Statistics per training set: key f is 'all folds but f'; without folds the only key is -1.

    Target encodings need ``label`` and a column ``inner_fold``.
    """
    numeric, categorical = list(numeric), list(categorical)
    extra = [label, "inner_fold"] if label else []
    width = folds or 1
    sets = {s: [f for f in range(width) if f != s] for s in (range(folds) if folds else [WHOLE])}
    data = df.select(
        *[number(c).alias(c) for c in numeric], *[F.col(c).cast("string").alias(c) for c in categorical],
        *[F.col(c).alias(f"__{c}") for c in extra], (F.col("fold") if folds else F.lit(0)).cast("int").alias("fold"),
    ).where(F.col("fold").between(0, width - 1))
    rows = _counted(data, numeric, categorical, label)
    found = {s: TrainingStats(numeric[:], categorical[:]) for s in sets}
    _numeric_stats(data, [r for r in rows if r["c"] < len(numeric)], numeric, sets, width, found, scalers)
    if categorical:
        _categorical_stats([r for r in rows if r["c"] >= len(numeric)], numeric, categorical, label, sets, found)
    return found


def _counted(data: DataFrame, numeric: list[str], categorical: list[str], label: str | None) -> list:
    """One pass for all counts: moments per fold and number; rows per fold, category, class and inner fold.

    ``c`` is the column's position, numbers first.
    """
    kind = data.schema[f"__{label}"].dataType if label else "string"
    none = [F.lit(None).cast(kind).alias("k"), F.lit(None).cast("int").alias("inner")]
    told = [F.col(f"__{label}").alias("k"), F.col("__inner_fold").cast("int").alias("inner")] if label else none
    cells = [
        *[F.struct(F.lit(i).alias("c"), F.lit(None).cast("string").alias("value"), F.col(f"`{c}`").alias("v"), *none) for i, c in enumerate(numeric)],
        *[
            F.struct(F.lit(len(numeric) + i).alias("c"), F.col(f"`{c}`").alias("value"), F.lit(None).cast("double").alias("v"), *told)
            for i, c in enumerate(categorical)
        ],
    ]
    if not cells:
        return []
    counts = data.select("fold", F.inline(F.array(*cells))).groupBy("fold", "c", "value", "k", "inner").agg(
        F.count("*").alias("rows"), F.count("v").alias("n"), F.avg("v").alias("avg"), F.var_pop("v").alias("var"),
        F.min("v").alias("low"), F.max("v").alias("high"),
    )
    rows = counts.take(MAX_COUNTS + 1)
    if len({(r["c"], r["value"]) for r in rows if r["c"] >= len(numeric)}) > MAX_CATEGORIES:
        raise ValueError(f"the text columns have more than {MAX_CATEGORIES} categories to encode")
    if len(rows) > MAX_COUNTS:
        raise ValueError(f"more than {MAX_COUNTS} counts of categories by fold and class; see panelkit.operators.dictionary")
    return rows


def _numeric_stats(
    data: DataFrame, rows: list, numeric: list[str], sets: dict[int, list[int]], width: int, found: dict[int, TrainingStats],
    scalers: Sequence[str],
) -> None:
    counted = fold_moments(rows, numeric, width)
    medians, boxes = medians_and_quartiles(data, counted, sets, "robust" in scalers)
    for s, stats in found.items():
        stats.dropped = [c for c in numeric if (s, c) not in medians]
        stats.numeric = [c for c in numeric if (s, c) in medians]
        for c in stats.numeric:
            stats.medians[c] = medians[s, c]
            whole = sum((counted[c][f] for f in sets[s]), Moments()).imputed(medians[s, c])
            stats.moments[c] = whole.mean, (whole.squares / whole.n) ** 0.5, whole.low, whole.high
            if "robust" in scalers:
                stats.quartiles[c] = boxes[s, c]


def _categorical_stats(
    rows: list, numeric: list[str], categorical: list[str], label: str | None, sets: dict[int, list[int]], found: dict[int, TrainingStats]
) -> None:
    classes = sorted({r["k"] for r in rows if r["k"] is not None})
    for s, stats in found.items():
        own = [(categorical[r["c"] - len(numeric)], r) for r in rows if r["fold"] in sets[s]]
        seen: dict[str, dict[str, int]] = {c: {} for c in categorical}
        for c, r in own:
            if r["value"] is not None:
                seen[c][r["value"]] = seen[c].get(r["value"], 0) + r["rows"]
        stats.categorical = [c for c in categorical if seen[c]]
        stats.dropped += [c for c in categorical if not seen[c]]
        for c in stats.categorical:
            stats.modes[c] = min(seen[c], key=lambda v: (-seen[c][v], v))
            stats.categories[c] = sorted(seen[c])
        if not label:
            continue
        stats.classes = classes
        for c, r in own:
            if c in stats.modes and r["k"] is not None:
                value = stats.modes[c] if r["value"] is None else r["value"]
                counts = stats.class_counts.setdefault((c, value, r["inner"]), {})
                counts[r["k"]] = counts.get(r["k"], 0) + r["rows"]
