"""The most frequent words of a corpus, counted over every text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm import arrow

#: Words that a task holds before it counts them and hands the counts on.
FLUSH = 4 << 20


def frequent_words(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of the `size` most frequent words (letters and digits, case ignored) of the
    column `text`; ties by hash. Tasks count before anything is shuffled; `size` rows come back."""

    def find(batches):
        held, waiting = [], 0

        def flush():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(arrow.signed(key)), pa.array(n)], ["word", "n"])

        for batch in batches:
            data, offsets = arrow.texts(batch.column(0), lower=True)
            for low, high in arrow.groups(offsets):
                held.append(arrow.words(data, offsets[low : high + 1], arrow.LETTERS).hashes)
                waiting += len(held[-1])
                if waiting > FLUSH:
                    yield flush()
                    held, waiting = [], 0
        if held:
            yield flush()

    counts = docs.select("text").mapInArrow(find, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(size).collect()
    return np.sort(np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64))
