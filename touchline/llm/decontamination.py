"""Benchmark decontamination: one automaton of test windows, one scan over each text.

Texts are normalised to lower-case words between single spaces. Windows of test items
become patterns of an Aho-Corasick automaton; hits are carried back to words and to
code points of the original text.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from touchline.llm.common import each_batch, materialise

WINDOW = 10
#: Characters of distinct windows in one automaton, which bounds what is broadcast
#: and the automaton's memory. More windows than that take further passes.
AUTOMATON_CHARS = 4_000_000
#: Everything in ASCII but letters and digits parts words; upper case is lowered.
FOLD = bytes(c if chr(c).isdigit() or c >= 128 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256))
WORD = re.compile(rb"[^\x20]+")


def words(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def _windows(size: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for item, text in zip(batch.column("item_id").to_pylist(), texts):
            found = words(text)
            for i in range(max(1, len(found) - size + 1) if found else 0):
                part = found[i : i + size]
                rows.append((item or "", b" ".join(part), len(part)))
        item, window, n = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(item, pa.string()), pa.array(window, pa.binary()), pa.array(n, pa.int32())],
            ["item", "window", "n"],
        )

    return run


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Distinct windows of `size` words of the items (item_id, text), each with its
    items. An item of fewer words is one window; one without words has none."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    rows = items.mapInArrow(each_batch(_windows(size)), "item string, window binary, n int")
    return rows.groupBy("window", "n").agg(F.sort_array(F.collect_set("item")).alias("items"))


_AUTOMATA: dict[str, object] = {}


def _automaton(shared: Broadcast, name: str):
    """Built once per Python worker; only the latest is kept."""
    if name not in _AUTOMATA:
        import ahocorasick

        built = ahocorasick.Automaton()
        for k, (window, n, _) in enumerate(shared.value):
            built.add_word(f" {window.decode('latin-1')} ", (n, k))
        built.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[name] = built
    return _AUTOMATA[name]


RESULT = {
    "n_words": pa.int64(),
    "n_hit": pa.int64(),
    "item_ids": pa.list_(pa.string()),
    "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
}


def _runs(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last positions of runs of true."""
    edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _positions(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code points at which each word of the text starts and ends."""
    data = np.frombuffer(text, np.uint8)
    before = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    spans = np.array([m.span() for m in WORD.finditer(text.translate(FOLD))], np.int64).reshape(-1, 2)
    return before[spans[:, 0]], before[spans[:, 1]]


def _scan(shared: Broadcast):
    name = uuid.uuid4().hex

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = {k: [] for k in RESULT}
        automaton = _automaton(shared, name)
        before = "spans" in batch.schema.names
        old_items = batch.column("item_ids").to_pylist() if before else None
        old_spans = batch.column("spans").to_pylist() if before else None
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            own = words(text)
            line = b" " + b" ".join(own) + b" "
            hits = list(automaton.iter(line.decode("latin-1"))) if own and len(automaton) else []
            items: set[str] = set(old_items[i]) if before else set()
            spans = old_spans[i] if before else []
            n_hit = 0
            if hits or spans:
                hit = np.zeros(len(own), bool)
                starts, ends = _positions(text)
                gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
                for end, (n, k) in hits:
                    last = int(np.searchsorted(gaps, end))
                    hit[last - n : last] = True
                    items.update(shared.value[k][2])
                for span in spans:
                    hit |= (starts >= span["start"]) & (ends <= span["end"])
                n_hit = int(hit.sum())
                spans = [{"start": int(starts[a]), "end": int(ends[b])} for a, b in zip(*_runs(hit))]
            for k, v in zip(RESULT, (len(own), n_hit, sorted(items), spans)):
                found[k].append(v)
        kept = [k for k in batch.schema.names if k not in RESULT]
        arrays = [batch.column(k) for k in kept] + [pa.array(found[k], t) for k, t in RESULT.items()]
        return pa.RecordBatch.from_arrays(arrays, kept + list(RESULT))

    return run


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, automaton_chars: int = AUTOMATON_CHARS
) -> DataFrame:
    """Every row of `docs` with what it shares with `benchmark`.

    Adds n_words, n_hit (words inside a window's occurrence), item_ids (sorted), spans
    (runs of hit words, code points of the original text, end exclusive), n_items and
    contaminated (n_hit > 0). A null text has no words. Items of a null id count as one
    item named ''. Columns of `docs` that bear a result's name give way to it; all
    others stay. Without items nothing is contaminated.

    The windows' size is measured first. They are broadcast in blocks of at most
    about `automaton_chars` characters, one pass over the documents for each.
    """
    spark = docs.sparkSession
    results = [*RESULT, "n_items", "contaminated"]
    rows = docs.select(*[f"`{c}`" for c in docs.columns if c not in results])
    found = materialise(windows(benchmark, size), "windows")
    chars = found.agg(F.sum(F.length("window"))).first()[0] or 0
    blocks = max(1, -(-chars // automaton_chars))
    block = F.pmod(F.xxhash64("window"), F.lit(blocks))
    for k in range(blocks):
        part = [(bytes(r["window"]), r["n"], r["items"]) for r in found.where(block == k).toLocalIterator()]
        shared = spark.sparkContext.broadcast(part)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in RESULT)
        own = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start:long,end:long>>"
        rows = rows.mapInArrow(each_batch(_scan(shared)), f"{fields}, {own}")
        if k + 1 < blocks:
            rows = materialise(rows, "decontaminated")
    return rows.withColumn("n_items", F.size("item_ids").cast("long")).withColumn("contaminated", F.col("n_hit") > 0)
