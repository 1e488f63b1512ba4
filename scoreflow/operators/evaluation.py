"""Model error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQueryListener


def _relative_error(label: str, prediction: str) -> Column:
    return F.abs((F.col(label) - F.col(prediction)) / F.nullif(F.col(label), F.lit(0)))


def mape(df: DataFrame, label: str, prediction: str, name: str = "mape") -> DataFrame:
    """Mean absolute percentage error, one row. Rows whose label is 0 do not count."""
    return df.agg((F.avg(_relative_error(label, prediction)) * 100).alias(name))


def with_observed_error(df: DataFrame, label: str, prediction: str, name: str = "error") -> DataFrame:
    """`df` as it is, whose error Spark sums up on the way to the sink: no second pass over a table or micro-batch.
    `ObservedError` with the same name reads the sums."""
    error = _relative_error(label, prediction)
    return df.observe(name, F.sum(error).alias("total"), F.count(error).alias("rows"))


class ObservedError(StreamingQueryListener):
    """Errors of the micro-batches of streams made by `with_observed_error`: (query id, batch id) -> (sum, rows).

    Register it with `spark.streams.addListener`. Spark reports a batch some time after it is done; a batch that
    runs again replaces its entry. The last `kept` batches stay one by one, earlier ones as a sum.
    """

    def __init__(self, name: str = "error", kept: int = 1000):
        self.name, self.kept = name, kept
        self.batches: dict[tuple[str, int], tuple[float, int]] = {}
        self.earlier = (0.0, 0)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        self.batches[str(event.progress.id), event.progress.batchId] = (row["total"] or 0.0, row["rows"] or 0)
        while len(self.batches) > self.kept:
            total, rows = self.batches.pop(next(iter(self.batches)))
            self.earlier = (self.earlier[0] + total, self.earlier[1] + rows)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def mape(self) -> float | None:
        """Over all batches so far."""
        totals, rows = zip(self.earlier, *self.batches.values())
        return 100 * sum(totals) / sum(rows) if sum(rows) else None
