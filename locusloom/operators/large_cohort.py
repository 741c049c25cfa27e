"""Validation fits for cohorts too large for product matrices: distributed rows, ``pyspark.ml``.

Same model as ``resampling``: genes scaled on the training part, constant genes without
effect, L2 penalty on all weights and on the intercept, balanced classes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusloom.operators.cohort import union_all
from locusloom.operators.ordered import ordered_scan
from locusloom.session import cut_lineage


def sample_vectors(burden: DataFrame, samples: DataFrame, sample: str = "sample_id") -> DataFrame:
    """Samples with a sparse gene vector; a vector is as long as the gene list, not the data."""
    genes = burden.select("gene_id", "gene_name").distinct().withColumn("_key", F.struct("gene_id", "gene_name"))
    numbered = ordered_scan(genes, [], "_key", {"_k": F.lit(1)})
    index = numbered.select("gene_id", "gene_name", F.col("_k_before").cast("int").alias("at"), F.col("_k_all").cast("int").alias("width"))
    cells = burden.select("gene_id", "gene_name", F.col("sample_id"), "n").join(index, ["gene_id", "gene_name"])
    rows = cells.groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("at", F.col("n").cast("double")))).alias("cells"))
    width = int(index.agg(F.max("width")).first()[0] or 0)

    @F.udf(VectorUDT())
    def vector(cells):
        return Vectors.sparse(width, cells or {})

    joined = samples.withColumnRenamed(sample, "sample_id").join(rows, "sample_id", "left")
    return cut_lineage(joined.withColumn("genes", vector("cells")).drop("cells"))


def fit_fold(train: DataFrame, test: DataFrame, y: str) -> DataFrame:
    """Probability and score of the test rows after one distributed fit."""
    sizes = {r[y]: r["count"] for r in train.groupBy(y).count().collect()}
    n = sum(sizes.values())
    if len(sizes) < 2:
        raise ValueError("training part has one class only")
    weight = F.when(F.col(y) == 1, n / (2.0 * sizes[1])).otherwise(n / (2.0 * sizes[0]))
    scaler = StandardScaler(inputCol="genes", outputCol="_z", withMean=True, withStd=True).fit(train)
    # The scaler divides by the sample deviation; the penalty is rescaled to the population one.
    ratio = (n - 1.0) / n
    assembler = VectorAssembler(inputCols=["_z", "_one"], outputCol="_x")

    def ready(df):
        return assembler.transform(scaler.transform(df).withColumn("_one", F.lit(ratio**0.5)))

    # Without an intercept, negating a row and its label changes nothing in the loss. Half
    # of the rows are negated because the learner skips columns without variance, which
    # the constant column of the penalised intercept would be.
    flip = F.pmod(F.xxhash64(*[F.col(c) for c in train.columns if c != "genes"]), F.lit(2)) == 1
    sign = F.when(flip, -1.0).otherwise(1.0)
    rows = ready(train).select(
        array_to_vector(F.transform(vector_to_array("_x"), lambda v: v * sign)).alias("_x"),
        F.when(flip, 1 - F.col(y)).otherwise(F.col(y)).cast("double").alias("_y"),
        weight.alias("_w"),
    )
    model = LogisticRegression(
        featuresCol="_x",
        labelCol="_y",
        weightCol="_w",
        fitIntercept=False,
        standardization=False,
        regParam=ratio / n,
        maxIter=5000,
        tol=1e-12,
    ).fit(rows)
    scored = model.transform(ready(test))
    return scored.select(
        *test.drop("genes").columns,
        vector_to_array("probability")[1].alias("prob_positive"),
        vector_to_array("rawPrediction")[1].alias("decision_score"),
    )


def validate(vectors: DataFrame, folds: Iterable[tuple[int, DataFrame]], y: str, sample: str = "sample_id") -> DataFrame:
    """Held-out predictions of every fold; a fold is ``(number, table of its test samples)``."""
    parts = []
    for number, held in folds:
        test = vectors.join(held.select(sample), sample, "left_semi")
        train = vectors.join(held.select(sample), sample, "left_anti")
        parts.append(cut_lineage(fit_fold(train, test, y).withColumn("fold", F.lit(number))))
    return union_all(parts)
