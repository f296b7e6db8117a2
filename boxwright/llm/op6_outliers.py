"""Quality rules with robust multivariate outliers: a minimum-covariance-determinant fit per language and source.

Five transformed statistics of each document form a vector. For every cell (language and source; language; all) the
fit starts at the coordinatewise median and MAD and makes concentration steps: keep the ``CORE`` share of rows nearest
by Mahalanobis distance, take their mean and covariance, repeat. To each variance is added the square of a floor: what
the least event (one symbol, one repeated line, one repeated window) changes in a document of the cell's median length,
so that a statistic that is 0 nearly everywhere does not reject all else. Rows are judged in their most specific cell of
at least ``MIN_CELL`` rows, by the squared distance, scaled so that the median row has the chi-square median. Beyond the
cutoff they are rejected. The cutoff is fitted to labelled documents, at most ``LABELLED`` of them, the first in hash order (see
fitted_cutoff); without labels of both classes it is ``CUTOFF``, the 0.999 quantile of chi-square.

Every step is an aggregation of sums or a mergeable quantile sketch over all documents, so a hot cell is combined before
the shuffle; only a row of parameters for each cell is inverted in Python. Defined results: a null or empty text has no
words and fails the base rule; null lang or source is a cell of its own; ties of a distance are kept together; equal
rows each get a row; a very long text is counted whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from boxwright.llm._shared import documents, written
from boxwright.llm._text import SPACE, U64, chunks, hashes, mix, segments, sums, utf8, words

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [f"f{i}" for i in range(5)]
MIN_CELL, CORE, STEPS, CUTOFF, CHI2_MEDIAN, LABELLED = 200, 0.75, 3, 20.515, 4.351, 20_000


def floors(n: np.ndarray | float) -> list:
    """What the least event changes of each feature in a text of n words: for lengths the noise of a mean of n words."""
    n = np.maximum(n, 1.0)
    return [n**-0.5, n**-0.5 / 2, n**-0.5, n**-0.25, (6 / n) ** 0.5]


def text_stats(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """COUNTS of each text."""
    n = len(offs) - 1
    space = SPACE[buf]
    s, e, doc = words(buf, offs)
    n_words = np.bincount(doc, minlength=n)
    chars = sums(~space & ((buf & 0xC0) != 0x80), offs)
    symbols = sums(SYMBOLS[buf], offs)
    # lines with a word: equal bytes within a document
    ls, le = segments(buf == 10, offs)
    has = sums(~space, np.append(ls, len(buf)))[: len(ls)] > 0 if len(ls) else np.zeros(0, bool)
    ls, le = ls[has], le[has]
    line_doc = np.searchsorted(offs, ls, "right") - 1
    line = mix(hashes(buf, ls, le) + line_doc.astype(U64) * U64(0x9E3779B97F4A7C15))
    _, first = np.unique(line, return_index=True)
    dup = np.ones(len(line), bool)
    dup[first] = False
    dup_lines = np.bincount(line_doc[dup], minlength=n)
    # 3-word windows that occur twice or more in their document
    h = hashes(buf, s, e)
    covered = np.zeros(len(h), bool)
    if len(h) > 2:
        at = np.flatnonzero(doc[:-2] == doc[2:])
        win = mix(mix(mix(h[at]) + h[at + 1]) + h[at + 2] + doc[at].astype(U64) * U64(0xD6E8FEB86659FD93))
        order = np.argsort(win, kind="stable")
        same = win[order][1:] == win[order][:-1]
        twice = np.zeros(len(win), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for k in range(3):
            covered[at[twice] + k] = True
    return [n_words, chars, symbols, dup_lines, np.bincount(doc[covered], minlength=n)]


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All columns, with COUNTS of the text."""
    for batch in batches:
        buf, offs = utf8(batch.column("text"))
        parts = [text_stats(buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]) for a, b in chunks(offs)]
        made = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [[] for _ in COUNTS]
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.int64()) for x in made)], [*batch.schema.names, *COUNTS])


def _counts_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _stats(batches):
        yield batch.select([n for n in batch.schema.names if n != "text"])


def _with_counts(rows: DataFrame, text: bool) -> DataFrame:
    """rows with COUNTS and base_failed, with or without the text."""
    kept = [f for f in rows.schema if text or f.name != "text"]
    schema = StructType([*kept, *(StructField(c, LongType()) for c in COUNTS)])
    stats = rows.mapInArrow(_stats if text else _counts_only, schema)
    return stats.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, COUNTS and base_failed of each whole text."""
    return _with_counts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("lang", "source", "text"))), False)


def features() -> list[Column]:
    """The transformed vector: log length, mean word length, symbols, repeated lines and repeated words (rooted shares)."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    shares = [F.sqrt(F.col("n_symbols") / n), F.sqrt(F.col("n_dup_lines") / F.sqrt(n)), F.sqrt(F.col("n_repeat_words") / n)]
    return [x.alias(f) for f, x in zip(FEATURES, [F.log1p(n), F.log1p(F.col("word_chars") / n), *shares], strict=True)]


def _cells() -> Column:
    """Cells of a row, most specific first."""
    null = F.lit("\0")  # null is not a name that a column can hold beside it
    lang, source = F.coalesce("lang", null), F.coalesce("source", null)
    return F.array(F.concat(F.lit("2\t"), lang, F.lit("\t"), source), F.concat(F.lit("1\t"), lang), F.lit("0"))


def _inverse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Means and inverse covariance (row-major) of each cell from its sums and its median length."""
    p = len(FEATURES)
    for x in frames:
        out = []
        for r in x.itertuples(index=False):
            mean = np.array([getattr(r, f"m{i}") for i in range(p)])
            cov = np.array([[getattr(r, f"c{min(i, j)}{max(i, j)}") for j in range(p)] for i in range(p)]) - np.outer(mean, mean)
            inv = np.linalg.inv(cov + np.diag(np.square(floors(np.expm1(r.middle)))))
            out.append((r.cell, mean.tolist(), inv.ravel().tolist()))
        yield pd.DataFrame(out, columns=["cell", "mean", "inv"])


def _distance() -> Column:
    p = len(FEATURES)
    diff = [F.col(f) - F.col("mean")[i] for i, f in enumerate(FEATURES)]
    total = F.lit(0.0)
    for i in range(p):
        row = F.lit(0.0)
        for j in range(p):
            row = row + F.col("inv")[i * p + j] * diff[j]
        total = total + row * diff[i]
    return total


def fit(rows: DataFrame) -> DataFrame:
    """cell, mean, inv, scale, n from rows of cell and FEATURES.

    Tables of a row a cell are written, so that their size is known before a join to the rows is planned: while they are
    small the rows are joined where they lie, and a hot cell does not meet in one task.
    """
    p = len(FEATURES)
    mids = written(rows.groupBy("cell").agg(F.count("*").alias("n"), *(F.percentile_approx(f, 0.5, 2000).alias(f"m{i}") for i, f in enumerate(FEATURES))), "mids")
    off = rows.join(mids, "cell").groupBy("cell").agg(*(F.percentile_approx(F.abs(F.col(f) - F.col(f"m{i}")), 0.5, 2000).alias(f"a{i}") for i, f in enumerate(FEATURES)))
    n = F.greatest(F.expm1("m0"), F.lit(1.0))
    least = [F.pow(n, F.lit(-0.5)), F.pow(n, F.lit(-0.5)) / 2, F.pow(n, F.lit(-0.5)), F.pow(n, F.lit(-0.25)), F.sqrt(6 / n)]  # floors(n)
    spread = [F.lit(1.0) / (F.pow(1.4826 * F.col(f"a{i}"), 2) + least[i] * least[i]) for i in range(p)]
    model = mids.join(off, "cell").select("cell", F.array(*(F.col(f"m{i}") for i in range(p))).alias("mean"), F.array(*(spread[i] if i == j else F.lit(0.0) for i in range(p) for j in range(p))).alias("inv"))
    for _ in range(STEPS):
        model = written(model, "mcd")
        near = rows.join(model, "cell").withColumn("d2", _distance())
        limit = written(near.groupBy("cell").agg(F.percentile_approx("d2", CORE, 2000).alias("limit")), "limit")
        core = near.join(limit, "cell").where(F.col("d2") <= F.col("limit"))
        moments = core.groupBy("cell").agg(*(F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)), *(F.avg(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"c{i}{j}") for i in range(p) for j in range(i, p)))
        moments = moments.join(mids.select("cell", F.col("m0").alias("middle")), "cell")
        model = moments.mapInPandas(_inverse, "cell string, mean array<double>, inv array<double>")
    model = written(model, "mcd")
    scale = rows.join(model, "cell").groupBy("cell").agg((F.percentile_approx(_distance(), 0.5, 2000) / F.lit(CHI2_MEDIAN)).alias("scale"), F.count("*").alias("n"))
    return model.join(scale, "cell")


def fitted_cutoff(judged: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> float:
    """The cutoff that tells labelled documents (doc_id, quality 0 or 1) best apart by d2.

    Of all cutoffs it takes those with the least sum of both classes' error shares, and of these the middle one of the
    widest gap (on a logarithmic scale) between neighbouring documents. At most ``labelled`` documents are looked at.
    """
    some = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select(F.col("doc_id").cast("long").alias("label_id"), "quality").orderBy(F.xxhash64("label_id"), "label_id").limit(labelled)
    rows = judged.where("d2 IS NOT NULL").select("doc_id", "d2").join(some, F.col("doc_id") == F.col("label_id")).select("d2", "quality").collect()
    d2, good = np.array([r.d2 for r in rows], float), np.array([r.quality == 1 for r in rows], bool)
    if not good.any() or good.all():
        return CUTOFF
    order = np.lexsort((~good, d2))
    d2, good = np.maximum(d2[order], 1e-9), good[order]
    error = (~good).cumsum() / (~good).sum() + 1 - good.cumsum() / good.sum()  # for a cutoff just above each document
    ends = np.append(d2[1:], d2[-1])
    width = np.where((error <= error.min() + 1e-12) & (ends > d2), np.log(ends / d2), 0.0)
    k = int(width.argmax())
    return float(np.sqrt(d2[k] * ends[k])) if width[k] > 0 else CUTOFF


def fitted(stats: DataFrame, min_cell: int = MIN_CELL) -> DataFrame:
    """cell, mean, inv, scale of the cells that rows may be judged in: those that are large enough, and that of all rows."""
    fair = stats.where(~F.col("base_failed")).select(F.explode(_cells()).alias("cell"), *features())
    return written(fit(fair).where((F.col("n") >= min_cell) | (F.col("cell") == "0")).select("cell", "mean", "inv", "scale"), "mcd")


def measured(stats: DataFrame, model: DataFrame) -> DataFrame:
    """stats with d2, the scaled squared distance in the row's most specific cell (null where the base rule rejects).

    The model has a row a cell; while that is small, Spark sends it to the rows, and they stay where they are.
    """
    out = stats.select("*", *features(), _cells().alias("cells"))
    for k in range(3):
        m = model.where(F.col("cell").startswith(str(2 - k))).select(F.col("cell").alias(f"cell{k}"), F.struct("mean", "inv", "scale").alias(f"p{k}"))
        out = out.withColumn(f"cell{k}", F.col("cells")[k]).join(m, f"cell{k}", "left")
    out = out.withColumn("p", F.coalesce("p0", "p1", "p2")).withColumns({"mean": F.col("p.mean"), "inv": F.col("p.inv")})
    d2 = F.when(~F.col("base_failed"), _distance() / F.greatest(F.col("p.scale"), F.lit(1e-9)))
    return out.select(*stats.columns, d2.alias("d2"))


def _kept(cutoff: float) -> Column:
    return ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= cutoff)


def judge(docs: DataFrame, min_cell: int = MIN_CELL, labels: DataFrame | None = None) -> DataFrame:
    """document_stats with kept and d2."""
    stats = written(document_stats(docs), "stats")
    judged = written(measured(stats, fitted(stats, min_cell)), "judged")
    cutoff = CUTOFF if labels is None else fitted_cutoff(judged, labels)
    return judged.select("doc_id", "lang", "source", *COUNTS, "base_failed", _kept(cutoff).alias("kept"), "d2")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir), labels=documents(spark, sf_dir, "labels")).drop("lang", "source", "d2")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules keep, with all columns, whatever their names; each row is judged by itself.

    Texts are counted once more beside the fitted model, rather than joined to verdicts, so no text is shuffled.
    """
    stats = written(document_stats(docs), "stats")
    model = fitted(stats)
    cutoff = fitted_cutoff(written(measured(stats, model).select("doc_id", "d2"), "judged"), documents(spark, sf_dir, "labels"))
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(*(F.col(c).cast("string").alias(c) for c in ("text", "lang", "source")), F.struct(*(F.col(f"`{c}`") for c in others)).alias("row"))
    judged = measured(_with_counts(rows, True), model).where(_kept(cutoff))
    return judged.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
