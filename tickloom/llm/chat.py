"""Multi-party perspective rotation, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered once with that speaker as the assistant and
the others as named users; masks say which characters the model is trained on. Long conversations are
rendered in chunks of ``CHUNK_TURNS`` turn numbers, and a chunk with many rows of one number (or of none) in parts of
``PART_ROWS``, so no row gathers an unbounded conversation; a conversation of ordinary length is one row for each
participant. The chunks and parts of a participant, in order, make up the whole rendering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

CHUNK_TURNS, PART_ROWS = 64, 1_024
#: Roles that speak but are nobody's perspective.
NARRATORS = ("system",)


def rotate_perspectives(turns: DataFrame, chunk_turns: int = CHUNK_TURNS, part_rows: int = PART_ROWS) -> DataFrame:
    """``conv_id, speaker, chunk, part, n_turns, n_own_turns, rendered, mask`` for every participant, chunk and part of ``turns``
    (conv_id, turn, role, text).

    A turn is ``<|assistant|>\\n{text}<|end|>\\n`` if the speaker said it, ``<|system|>\\n...`` for a narrator, else
    ``<|user:{role}|>\\n...``. ``mask`` has a string ``start:end`` (code points, end exclusive) for each own turn's text and
    end mark, comma-joined. chunk is floor(turn / chunk_turns), part floor(place in the chunk / part_rows).

    Order is by turn, then role, then text; equal rows repeat. A null turn goes last, in a chunk -1 of its own. A
    null or empty text is an empty turn. A null role is rendered as ``<|user:unknown|>`` and is no participant. Rows with
    a null conv_id are dropped from no one's dialogue but their own: they form one conversation with a null id. A
    conversation whose only speakers are narrators has no row. Other columns are ignored.
    """
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    speakers = rows.where(F.col("role").isNotNull() & ~F.col("role").isin(*NARRATORS)).select("conv_id", F.col("role").alias("speaker")).distinct()
    chunk = F.coalesce(F.floor(F.col("turn") / chunk_turns), F.lit(-1)).alias("chunk")
    said = F.struct(F.coalesce("turn", F.lit((1 << 63) - 1)).alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), "text")
    in_order = Window.partitionBy("conv_id", "chunk").orderBy(F.asc_nulls_last("turn"), F.coalesce("role", F.lit("unknown")), "text")
    parted = rows.withColumn("chunk", chunk).withColumn("part", F.floor((F.row_number().over(in_order) - 1) / part_rows))
    chunks = parted.groupBy("conv_id", "chunk", "part").agg(F.sort_array(F.collect_list(said)).alias("said"))
    paired = chunks.join(speakers.withColumnRenamed("conv_id", "__conv"), F.col("conv_id").eqNullSafe(F.col("__conv")))
    own = lambda t: t["role"] == F.col("speaker")
    head = lambda t: F.when(own(t), F.lit("<|assistant|>\n")).when(t["role"].isin(*NARRATORS), F.concat(F.lit("<|"), t["role"], F.lit("|>\n"))).otherwise(F.concat(F.lit("<|user:"), t["role"], F.lit("|>\n")))
    parts = F.transform("said", lambda t: F.struct(head(t).alias("head"), F.concat(t["text"], F.lit("<|end|>")).alias("body"), own(t).alias("own")))

    def step(state, p):
        start = state["at"] + F.length(p["head"])
        end = start + F.length(p["body"])
        return F.struct((end + 1).alias("at"), F.when(p["own"], F.concat(state["out"], F.array(F.concat_ws(":", start, end)))).otherwise(state["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    shown = paired.withColumn("parts", parts)
    return shown.select(
        "conv_id",
        "speaker",
        F.col("chunk").cast("long").alias("chunk"),
        F.col("part").cast("long").alias("part"),
        F.size("said").cast("long").alias("n_turns"),
        F.size(F.filter("parts", lambda p: p["own"])).cast("long").alias("n_own_turns"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("rendered"),
        F.array_join(F.aggregate("parts", zero, step, lambda s: s["out"]), ",").alias("mask"),
    )


ORACLE_SQL = """
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text, coalesce(CAST(floor(turn / 64) AS BIGINT), -1) AS chunk,
         coalesce(role, 'unknown') AS said_by,
         (row_number() OVER (PARTITION BY conv_id, coalesce(CAST(floor(turn / 64) AS BIGINT), -1) ORDER BY turn NULLS LAST, coalesce(role, 'unknown'), coalesce(text, '')) - 1) // 1024 AS part
  FROM conversations
), speakers AS (
  SELECT DISTINCT conv_id AS c, role AS speaker FROM rows WHERE role IS NOT NULL AND role NOT IN ('system')
), parts AS (
  SELECT conv_id, speaker, chunk, part, turn, said_by, text, said_by = speaker AS own,
         CASE WHEN said_by = speaker THEN '<|assistant|>' || chr(10)
              WHEN said_by IN ('system') THEN '<|' || said_by || '|>' || chr(10)
              ELSE '<|user:' || said_by || '|>' || chr(10) END AS head,
         text || '<|end|>' AS body
  FROM rows JOIN speakers ON conv_id IS NOT DISTINCT FROM c
), placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
    PARTITION BY conv_id, speaker, chunk, part ORDER BY turn NULLS LAST, said_by, text
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS start FROM parts
)
SELECT conv_id, speaker, chunk, part, count(*) AS n_turns, count(*) FILTER (own) AS n_own_turns,
       string_agg(head || body || chr(10), '' ORDER BY turn NULLS LAST, said_by, text) AS rendered,
       coalesce(string_agg(CAST(CAST(start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(start + length(body) AS BIGINT) AS VARCHAR), ',' ORDER BY turn NULLS LAST, said_by, text) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, speaker, chunk, part
"""
