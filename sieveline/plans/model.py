"""The boundary to a language model: any function (prompt, context) -> response, and a deterministic stub.

Clients with keys, rate limits and retries live behind that function, outside the engine.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import records as R
from ..functions.classify import negated

Model = Callable[[str, str], str]


def stub(prompt: str, context: str) -> str:
    """An answer made from a hash of the prompt: a verdict object, or pairs if the prompt asks for qa_pairs."""
    h = hashlib.sha256(prompt.encode()).hexdigest()
    if "qa_pairs" in prompt:
        return json.dumps({"qa_pairs": [{"question": f"What does part {i} of {h[:8]} state?", "answer": context[:60] or "nothing"} for i in range(5)]}, ensure_ascii=False)
    if "JSON array" in prompt:
        return json.dumps([{"type": "correct" if i % 2 else "incorrect", "claim": f"{h[:6]} {i}", "context": context[:60], "explanation": "by the context", "reference": "UNKNOWN"} for i in range(4)], ensure_ascii=False)
    return json.dumps({"verdict": "True" if int(h[0], 16) % 2 else "False", "explanation": context[:40], "reference": "UNKNOWN"}, ensure_ascii=False)


def with_fallback(models: list[Model], tries: int = 3, wait: Callable[[int], float] = lambda k: 0.0) -> Model:
    """Asks a model up to `tries` times, waiting between, then the next; the last error is raised."""

    def ask(prompt: str, context: str) -> str:
        last: Exception = ValueError("no model")
        for model in models:
            for k in range(tries):
                try:
                    if out := model(prompt, context):
                        return out
                    last = ValueError("empty response")
                    break
                except Exception as e:  # noqa: BLE001  whatever a client raises
                    last = e
                    time.sleep(wait(k))
        raise last

    return ask


#: Rows and bytes of prompts and contexts that a task hands on at a time.
SLICE, SLICE_BYTES = 256, 4 << 20


def _slices(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Batches of at most SLICE rows and SLICE_BYTES bytes, or of one row; they share the memory of what came in."""
    for batch in batches:
        ends, start = np.cumsum(size(batch)), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = min(max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))), start + SLICE)
            yield batch.slice(start, stop - start)
            start = stop


def responses(df: DataFrame, model: Model, *, prompt_col: str = "prompt", context_col: str = "context") -> DataFrame:
    """df with `response`, null where the model failed, and `error`. A task holds the rows that Spark sends at once, as they come, and
    texts and answers of a small slice of them."""
    bytes_ = lambda batch: sum(pc.fill_null(pc.binary_length(batch[c]), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in (prompt_col, context_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, bytes_):
            got, errors = [], []
            for p, c in zip(batch[prompt_col], batch[context_col], strict=True):
                try:
                    got.append(model(p.as_py(), c.as_py()))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  a failure loses its row only
                    got.append(None)
                    errors.append(str(e))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.string()), pa.array(errors, pa.string())], [*batch.schema.names, "response", "error"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, response string, error string")


def qa_for_chunks(chunks: DataFrame, model: Model, *, count: int = 5) -> DataFrame:
    """question, answer, chunk_id, language, word_count of each chunk's pairs; failures give none. chunks: chunk_id, text, language, word_count."""
    asked = responses(chunks.withColumn("prompt", R.prompt("qa", F.col("language"), F.col("text"), count=count)), model, context_col="text")
    return asked.select("chunk_id", "language", "word_count", F.explode(R.parse_qa(F.col("response"))).alias("qa")).select("qa.question", "qa.answer", "chunk_id", "language", "word_count")


def examples_for_seeds(seeds: DataFrame, model: Model, *, task: str = "examples") -> DataFrame:
    """type, claim, explanation, reference of generated examples, with their seed_id. seeds: seed_id, claim, context, language."""
    asked = responses(seeds.withColumn("prompt", R.prompt(task, F.col("language"), F.col("context"), F.col("claim"))), model)
    parsed = F.from_json(R.strip_fence(F.col("response"), strict=True), "array<struct<type: string, claim: string, explanation: string, reference: string>>")
    return asked.select("seed_id", F.explode(parsed).alias("e")).select("seed_id", "e.*")


def second_judge(claim: Column) -> Column:
    return F.when(negated(claim), "False").otherwise("True")
