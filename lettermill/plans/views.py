"""Relations that several queries start from, in both forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.classify import sql_noise_flags
from ..functions.regexlib import sql_stripped, sql_words
from ..operators.curate import TRIVIAL_REPLIES
from ..operators.dataset import ARTEFACTS

_noise = sql_noise_flags("body")["noise"]
_RECORDS = f"""
WITH base AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'you' ELSE 'partner' END AS role, {T.sql_clean_common("coalesce(text, '')")} AS body FROM conversations),
records AS (SELECT *, {_noise} AS noise, {sql_stripped('body')} AS plain, conv_id::VARCHAR || '-' || turn::VARCHAR || '-' || turn::VARCHAR AS tail FROM base WHERE body <> '')"""
MONOS_SQL = f"SELECT 'mono-' || tail AS id, plain AS text FROM records WHERE role = 'you' AND NOT noise AND (length(plain) >= 30 OR len({sql_words('plain')}) >= 5)"
_artefacts = "".join(f" AND NOT contains(lower(text), '{a}')" for a in ARTEFACTS)
MONO_SQL = f"""{_RECORDS}, all_monos AS ({MONOS_SQL}), monos AS (SELECT * FROM all_monos WHERE length(text) >= 3{_artefacts})
"""
PAIRS_SQL = f"""{_RECORDS},
framed AS (SELECT *, coalesce(list({{'role': role, 'text': body, 'noise': noise}}) OVER (PARTITION BY conv_id ORDER BY lpad(turn::VARCHAR, 6, '0'), turn ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), []) AS frame,
  last_value(CASE WHEN role = 'partner' AND plain <> '' THEN plain END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY lpad(turn::VARCHAR, 6, '0'), turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS partner FROM records),
own AS (SELECT *, [x.role || ': ' || x.text FOR x IN frame IF NOT x.noise] AS kept FROM framed WHERE role = 'you' AND NOT noise AND length(plain) >= 3 AND lower(plain) NOT IN ({', '.join(f"'{t}'" for t in TRIVIAL_REPLIES)})),
filled AS (SELECT *, CASE WHEN len(kept) > 0 THEN kept WHEN partner IS NOT NULL THEN ['partner: ' || partner] END AS ctx FROM own),
pairs AS (SELECT 'pair-' || tail AS id, array_to_string(ctx, chr(10)) AS context, plain AS target_text, len(ctx) AS size, ctx FROM filled WHERE ctx IS NOT NULL)
"""
_clean = "".join(f" AND NOT contains(lower(target_text), '{a}')" for a in ARTEFACTS)
CHAT_SQL = f""", chats AS (SELECT id, array_to_string([CASE WHEN starts_with(c, 'you: ') THEN 'assistant=' || substr(c, 6) ELSE 'user=' || substr(c, 10) END FOR c IN ctx], chr(10)) || chr(10) || 'assistant=' || target_text AS messages, target_text
FROM pairs WHERE length(target_text) >= 3{_clean}), monos_of_pairs AS (SELECT id FROM ({MONOS_SQL}) WHERE length(text) >= 3{_artefacts})
"""


def ratings(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents as ratings: quality tells the owner's from machine texts, toxicity the two machines; long texts are
    taken for a machine's."""
    rows = docs.select("doc_id", "text", "source", "lang", "n_chars").join(labels.select("doc_id", "quality", "toxic"), "doc_id")
    return rows.select(
        F.col("source").alias("prompt_id"), F.col("lang").alias("rater_id"), F.when(F.col("quality") == 1, "Human").when(F.col("toxic") == 1, "Base").otherwise("LoRA").alias("key"),
        F.when(F.col("n_chars") > 2000, "AI").otherwise("owner").alias("guess"), (1 + F.least(F.lit(4), F.floor(F.col("n_chars") / 1000))).cast("int").alias("confidence_1to5"), F.col("text").alias("answer"),
    )


RATINGS_SQL = """
WITH r AS (SELECT source AS prompt_id, lang AS rater_id, CASE WHEN quality = 1 THEN 'Human' WHEN toxic = 1 THEN 'Base' ELSE 'LoRA' END AS key, CASE WHEN n_chars > 2000 THEN 'AI' ELSE 'owner' END AS guess,
  1 + least(4, n_chars // 1000) AS confidence_1to5, text AS answer FROM documents JOIN labels USING (doc_id))
"""
