"""Generated texts: the frame around a model that the user brings."""

from __future__ import annotations

import time
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame

#: What a text begins with that could not be generated.
FAILED = "ERROR"


def generated(rows: DataFrame, prompt: str, out: str, call: Callable[[str], str], retries: int = 3, least: int = 1, wait: float = 0.0) -> DataFrame:
    """rows with out: what call (prompt -> text) says to the prompt column. A call that raises, or whose text has under least
    characters, is made again, after wait seconds; after retries more the text is "ERROR: " and the reason. A null prompt has
    a null text and is not called. call runs on executors, a row at a time: bound its rate by the number of partitions."""

    def said(text: str | None) -> str | None:
        if text is None:
            return None
        reason = ""
        for _ in range(retries + 1):
            try:
                found = call(text)
                if found is not None and len(found.strip()) >= least:
                    return found.strip()
                reason = "too short"
            except Exception as e:  # noqa: BLE001  a model's failure is a result here
                reason = str(e)
            time.sleep(wait)
        return f"{FAILED}: {reason}"

    def each(frames):
        for frame in frames:
            yield frame.assign(**{out: pd.Series([said(t) for t in frame[prompt]], index=frame.index, dtype=object)})

    kept = rows.drop(out)
    return kept.mapInPandas(each, f"{', '.join(f'`{n}` {t}' for n, t in kept.dtypes)}, `{out}` string")


def rewritten(rows: DataFrame, source: str, out: str, call: Callable[[str], str], instruction: str = "Rewrite in the owner's style: ", **how) -> DataFrame:
    """Texts rewritten by a second model; failed ones are handed on as they are."""
    from pyspark.sql import functions as F

    asked = rows.withColumn("__ask", F.when(~F.col(source).startswith(FAILED), F.concat(F.lit(instruction), F.col(source))))
    done = generated(asked, "__ask", out, call, **how).drop("__ask")
    return done.withColumn(out, F.coalesce(out, source))
