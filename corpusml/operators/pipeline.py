"""Feature pipeline by convention: every stage rewrites ``features``.

Stages are ordinary ``pyspark.ml`` estimators or transformers with
``inputCol`` / ``outputCol``.  They are compiled into one
``pyspark.ml.Pipeline`` with generated intermediate columns; after
``fit``/``transform`` the last output replaces ``features`` (moved to the
end), every other column survives.  No stage = identity.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame

COLUMN = "features"


class FeaturePipeline:
    def __init__(self, stages=(), column: str = COLUMN):
        self._stages = list(stages)
        self._column = column
        self.model: PipelineModel | None = None
        self._held: list[DataFrame] = []

    def add(self, stage) -> "FeaturePipeline":
        """Append a stage; returns ``self`` for chaining."""
        self._stages.append(stage)
        self.model = None
        return self

    @property
    def is_root(self) -> bool:
        return not self._stages

    @property
    def stages(self) -> list:
        return list(self._stages)

    def _columns(self) -> list[str]:
        return [f"_{self._column}_{i}" for i in range(len(self._stages))]

    def _pipeline(self) -> Pipeline:
        cols = [self._column] + self._columns()
        compiled = [st.copy({st.inputCol: cols[i], st.outputCol: cols[i + 1]})
                    for i, st in enumerate(self._stages)]
        return Pipeline(stages=compiled)

    def _finish(self, x: DataFrame) -> DataFrame:
        cols = self._columns()
        return x.drop(self._column, *cols[:-1]).withColumnRenamed(cols[-1], self._column)

    def fit(self, x: DataFrame, cache_vectors: bool = False) -> DataFrame:
        """Fit every stage on the output of the previous one; returns the
        transformed data and keeps the fitted model on ``self.model``.

        ``cache_vectors``: persist the first vector-valued intermediate when
        a later estimator still has to read it (e.g. counts before ``IDF``),
        so the tokenizer runs once for both fits.  Sparse count vectors are
        far smaller than the token lists.  ``release()`` frees it.
        """
        if self.is_root:
            return x
        if not cache_vectors:
            self.model = self._pipeline().fit(x)
            return self._finish(self.model.transform(x))
        cur, fitted = x, []
        stages = self._pipeline().getStages()
        for i, st in enumerate(stages):
            m = st.fit(cur) if isinstance(st, Estimator) else st
            fitted.append(m)
            cur = m.transform(cur)
            later = any(isinstance(s, Estimator) for s in stages[i + 1:])
            out = st.getOutputCol()
            if later and not self._held and dict(cur.dtypes).get(out) == "vector":
                cur = cur.drop(*[c for c in [self._column] + self._columns()[:i] if c in cur.columns])
                cur = cur.persist(StorageLevel.MEMORY_AND_DISK)
                self._held.append(cur)
        self.model = PipelineModel(stages=fitted)
        return cur.drop(*[c for c in [self._column] + self._columns()[:-1] if c in cur.columns]) \
                  .withColumnRenamed(self._columns()[-1], self._column)

    def release(self) -> None:
        """Unpersist what ``fit(cache_vectors=True)`` kept."""
        for df in self._held:
            df.unpersist()
        self._held = []

    def transform(self, x: DataFrame) -> DataFrame:
        if self.is_root:
            return x
        if self.model is None:
            raise RuntimeError("FeaturePipeline.transform called before fit")
        return self._finish(self.model.transform(x))
