"""Datasets for supervised fine-tuning: messages, gates, formats, synthetic questions and answers."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import licence
from corpusloom.functions import text as tx

ROLES = ("system", "user", "assistant")
# Role names of the other chat format.
SHAREGPT = {"system": "system", "user": "human", "assistant": "gpt"}
MESSAGES = "array<struct<role:string,content:string>>"


def to_messages(columns: list[str]) -> Column:
    """The messages a record has, else its text as one assistant turn."""
    text = F.array(F.struct(F.lit("assistant").alias("role"), F.coalesce("text", F.lit("")).alias("content"))) if "text" in columns else F.lit(None).cast(MESSAGES)
    if "messages" not in columns:
        return text
    return F.when(F.size("messages") > 0, F.col("messages")).otherwise(text)


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, messages: turns of a conversation in order."""
    parts = F.sort_array(F.collect_list(F.struct("turn", F.col("role").alias("role"), F.col("text").alias("content"))))
    return turns.groupBy("conv_id").agg(F.transform(parts, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def gate(records: DataFrame) -> DataFrame:
    """Adds messages and drop_reason: no provenance, an invalid record, an unknown licence (before anything is generated), null to keep."""
    cols = records.columns
    out = records.withColumn("messages", to_messages(cols))
    prov = F.col("prov") if "prov" in cols else F.lit(None).cast("struct<license:string,source_url:string>")
    bad_role = F.exists("messages", lambda m: m["role"].isNull() | ~m["role"].isin(*ROLES) | m["content"].isNull())
    reason = F.when(prov.isNull(), "no_provenance").when(prov["source_url"].isNull() | ~F.coalesce(prov["license"].isin(*licence.TAGS), F.lit(False)), "invalid_record")
    return out.withColumn("drop_reason", reason.when(prov["license"] == licence.UNKNOWN, "license_unknown").when(F.coalesce(bad_role, F.lit(True)), "invalid_record"))


def chatml(messages: Column) -> Column:
    return F.struct(messages.alias("messages"))


def sharegpt(messages: Column) -> Column:
    name = F.create_map(*[F.lit(x) for kv in SHAREGPT.items() for x in kv])
    return F.struct(F.transform(messages, lambda m: F.struct(name[m["role"]].alias("from"), m["content"].alias("value"))).alias("conversations"))


def alpaca(messages: Column) -> Column:
    """The first user turn and the first assistant turn, else the last turn."""
    first = lambda role: F.get(F.filter(messages, lambda m: m["role"] == role), F.lit(0))["content"]
    return F.struct(F.coalesce(first("user"), F.lit("")).alias("instruction"), F.lit("").alias("input"), F.coalesce(first("assistant"), F.element_at(messages, -1)["content"]).alias("output"))


FORMATS = {"chatml": chatml, "sharegpt": sharegpt, "alpaca": alpaca}


def serialize(records: DataFrame, fmt: str) -> DataFrame:
    """record: a JSON line in the format, with id, language and provenance as meta."""
    meta = F.struct("id", "lang", "prov.*", (F.col("prov.license") != licence.UNKNOWN).alias("is_publishable"))
    body = FORMATS[fmt](F.col("messages"))
    names = {"chatml": ["messages"], "sharegpt": ["conversations"], "alpaca": ["instruction", "input", "output"]}[fmt]
    return records.select("id", F.to_json(F.struct(*[body[n].alias(n) for n in names], meta.alias("meta")), {"ignoreNullFields": "false"}).alias("record"))


def json_object(raw: str) -> dict:
    """The object from the first brace to the last."""
    start, end = raw.find("{"), raw.rfind("}")
    if start < 0 or end <= start:
        raise ValueError("no JSON object")
    out = json.loads(raw[start : end + 1])
    if not isinstance(out, dict):
        raise ValueError("not a JSON object")
    return out


def synthesize(records: DataFrame, llm: Callable[[list[dict]], str], model: str, questions: int = 2, max_chars: int | None = 4000, attempts: int = 2) -> DataFrame:
    """id, n, question, answer, drop_reason: up to `questions` pairs for each record (id, text), or synth_failed. llm takes messages and gives a reply.

    It is shown the first max_chars characters of a text, all of it with None."""
    ask = f'Write {questions} questions with answers, in the language of the passage and from it alone. Reply with one JSON object: {{"pairs": [{{"question": "...", "answer": "..."}}]}}'

    def pairs(text: str) -> list[tuple[str, str]]:
        messages = [{"role": "system", "content": ask}, {"role": "user", "content": (text or "")[:max_chars]}]
        for _ in range(attempts):
            reply = llm(messages)
            try:
                found = [(str(p["question"]).strip(), str(p["answer"]).strip()) for p in json_object(reply)["pairs"]]
                if found := [p for p in found if all(p)]:
                    return found[:questions]
                raise ValueError("no pairs")
            except (ValueError, KeyError, TypeError) as e:
                messages += [{"role": "assistant", "content": reply}, {"role": "user", "content": f"That was not valid ({e}). Reply with the JSON object alone."}]
        return []

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for i, text in zip(part["id"], part["text"], strict=True):
                found = pairs(text)
                rows += [(i, n, q, a, None) for n, (q, a) in enumerate(found)] or [(i, None, None, None, "synth_failed")]
            yield pd.DataFrame(rows, columns=["id", "n", "question", "answer", "drop_reason"]).astype({"n": "Int32"})

    out = records.select(F.col("id").cast("string").alias("id"), "text").mapInPandas(run, "id string, n int, question string, answer string, drop_reason string")
    own = tx.stable_id(F.col("id"), F.col("n").cast("string"))
    return out.withColumn("synth_id", own).withColumn("synthetic", F.lit(True)).withColumn("synth_model", F.lit(model))
