"""Work that waits for a summary, as queries; and the loop that does it with bounded attempts."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.extract import ordered_text

MENTION = ["bill", "sitting_url", "stage"]
TOPIC = ["sitting_url", "section_type", "title"]


class Summarizer(Protocol):
    def summarize(self, prompt: str) -> str: ...


class Embedder(Protocol):
    def embed(self, text: str) -> list[float]: ...


def _null_safe(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    b = b.select(*[F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in b.columns])
    on = None
    for k in keys:
        x = a[k].eqNullSafe(b[f"_{k}"])
        on = x if on is None else on & x
    return a.join(b, on, how).drop(*[f"_{k}" for k in keys])


def bill_speakers(appearances: DataFrame, mentions: DataFrame, speakers: DataFrame, bills: DataFrame, members: DataFrame, limit: int) -> DataFrame:
    a = appearances.filter("contributions_text is not null and summary is null")
    a = _null_safe(a, mentions.select(*MENTION, "house", "date"), MENTION).join(bills.select(F.col("name").alias("bill"), "bill_number"), "bill")
    a = _null_safe(a, speakers.select(F.col("name").alias("speaker_name"), F.col("url").alias("speaker_url"), "member_url"), ["speaker_name", "speaker_url"])
    a = a.join(members.select(F.col("url").alias("member_url"), F.col("name").alias("member_name"), "role", "constituency"), "member_url", "left")
    return a.orderBy("date", *MENTION, "speaker_name", "speaker_url").limit(limit)


def topic_speakers(appearances: DataFrame, topics: DataFrame, sittings: DataFrame, speakers: DataFrame, members: DataFrame, limit: int) -> DataFrame:
    a = appearances.filter("contributions_text is not null and summary is null")
    a = a.join(topics.select(*TOPIC), TOPIC).join(sittings.select(F.col("url").alias("sitting_url"), "house", "date"), "sitting_url")
    a = _null_safe(a, speakers.select(F.col("name").alias("speaker_name"), F.col("url").alias("speaker_url"), "member_url"), ["speaker_name", "speaker_url"])
    a = a.join(members.select(F.col("url").alias("member_url"), F.col("name").alias("member_name"), "role", "constituency"), "member_url", "left")
    return a.orderBy("date", *TOPIC, "speaker_name", "speaker_url").limit(limit)


def topics(topics_: DataFrame, sittings: DataFrame, limit: int) -> DataFrame:
    t = topics_.filter("summary is null and speech_count > 0")
    return t.join(sittings.select(F.col("url").alias("sitting_url"), "house", "date", "session_type", "sections"), "sitting_url").orderBy(F.desc("date"), *TOPIC).limit(limit)


def mentions(mentions_: DataFrame, bills: DataFrame, sittings: DataFrame, limit: int) -> DataFrame:
    m = mentions_.filter("summary is null and speech_count > 0").drop("house", "date")
    m = m.join(bills.select(F.col("name").alias("bill"), "bill_number"), "bill").join(sittings.select(F.col("url").alias("sitting_url"), "house", "date", "session_type", "sections"), "sitting_url")
    return m.orderBy(F.desc("date"), *MENTION).limit(limit)


def journeys(bills: DataFrame, mentions_: DataFrame, appearances: DataFrame, limit: int) -> DataFrame:
    """Bills without summary with their mentions by date, each with its summary and its speakers' texts (null where none spoke)."""
    said = appearances.filter("contributions_text is not null").groupBy(*MENTION).agg(ordered_text(["speaker_name", "speaker_url"], "contributions_text", "\n\n").alias("speakers_text"))
    m = _null_safe(mentions_, said, MENTION, "left")
    m = m.groupBy("bill").agg(F.sort_array(F.collect_list(F.struct("date", "sitting_url", "house", "stage", "section_title", "summary", "speakers_text"))).alias("mentions"))
    return bills.filter("summary is null").join(m, bills.name == m.bill).drop("bill").orderBy("name").limit(limit)


def sittings(sittings_: DataFrame, limit: int) -> DataFrame:
    return sittings_.filter("generated_summary is null").orderBy(F.desc("date"), "url").limit(limit)


#: Calls in flight in a task, by stored table; summaries of whole sittings are the heavy ones. Fixed values.
CALLS, CALLS_OF = 4, {"sittings": 2}


def calls(name: str, asked: int = CALLS) -> int:
    """How many calls a task may have in flight for a table."""
    return max(1, min(asked, CALLS_OF.get(name, asked)))


def _in_flight(make: Callable, call: Callable, at_once: int) -> Callable:
    """A function of a list of values to their results in order (None where a call fails or the value is null), with up to
    at_once calls at a time, each thread with an object of its own from make()."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import local

    own, pool = local(), ThreadPoolExecutor(at_once)

    def one(value):
        if value is None:
            return None
        try:
            if not hasattr(own, "made"):
                own.made = make()
            return call(own.made, value)
        except Exception:  # noqa: BLE001  a failed item is reported as pending, never retried without end
            return None

    return lambda values: list(pool.map(one, values))


def _answered(rows: DataFrame, column: str, make: Callable, call: Callable, at_once: int, kind: str) -> DataFrame:
    """rows with _made: what calls make of a column."""

    def run(batches):
        import pyarrow as pa

        work, kind_ = _in_flight(make, call, at_once), pa.string() if kind == "string" else pa.list_(pa.float32())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(work(batch.column(column).to_pylist()), kind_)], names=[*batch.schema.names, "_made"])

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", _made {kind}")


def answer(rows: DataFrame, prompt_col: str, make: Callable[[], Summarizer], model: str, at_once: int = CALLS, told: Observation | None = None) -> DataFrame:
    """rows with summary and summary_model; make() builds a summarizer for each thread of a task; what fails stays null.
    told: counts answered, failed and the characters of both sides in the job that writes the rows."""
    out = _answered(rows.drop("summary", "summary_model"), prompt_col, make, lambda x, prompt: x.summarize(prompt), at_once, "string")
    if told:
        out = out.observe(told, F.count("_made").alias("answered"), F.count_if(F.col("_made").isNull()).alias("failed"), F.sum(F.length(prompt_col)).alias("characters_in"), F.sum(F.length("_made")).alias("characters_out"))
    return out.withColumnRenamed("_made", "summary").withColumn("summary_model", F.when(F.col("summary").isNotNull(), model))


def embedded(rows: DataFrame, text_col: str, make: Callable[[], Embedder], at_once: int = CALLS) -> DataFrame:
    """rows with embedding (array of float); make() as in answer; what fails stays null."""
    return _answered(rows.drop("embedding"), text_col, make, lambda x, said: [float(v) for v in x.embed(said)], at_once, "array<float>").withColumnRenamed("_made", "embedding")


# Keys and written columns of the stored tables that take summaries; sittings keep the source's own summary apart.
TARGETS = {
    "sittings": (["url"], {"summary": "generated_summary", "summary_model": "summary_model"}),
    "bills": (["name"], {}),
    "bill_mentions": (MENTION, {}),
    "bill_mention_speakers": ([*MENTION, "speaker_name", "speaker_url"], {}),
    "topics": (TOPIC, {}),
    "topic_speakers": ([*TOPIC, "speaker_name", "speaker_url"], {}),
}


def store(table: DataFrame, name: str, answered: DataFrame, columns: tuple[str, ...] = ("summary", "summary_model")) -> DataFrame:
    """table with what answered says written over the columns, by the table's key (nulls are equal); rows that answered
    does not name, or has no value for, keep theirs. columns: or ("embedding",)."""
    keys, renamed = TARGETS[name]
    new = answered.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(c).alias(f"_new_{renamed.get(c, c)}") for c in columns]).dropDuplicates([f"_{k}" for k in keys])
    on = [table[k].eqNullSafe(new[f"_{k}"]) for k in keys]
    written = {renamed.get(c, c): c for c in columns}
    out = table.join(new, on, "left")
    kept = [F.coalesce(f"_new_{c}", table[c]).alias(c) if c in written else table[c] for c in table.columns]
    return out.select(*kept, *[F.col(f"_new_{c}").alias(c) for c in written if c not in table.columns])


def drain(pending: Callable[[int], DataFrame], work: Callable[[DataFrame], int], batch: int = 10, attempts: int = 3) -> int:
    """Repeats pending -> work until nothing is pending or `attempts` batches in a row write nothing."""
    done = idle = 0
    while idle < attempts:
        rows = pending(batch)
        if rows.isEmpty():
            break
        wrote = work(rows)
        done, idle = done + wrote, 0 if wrote else idle + 1
    return done
