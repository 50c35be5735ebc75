"""Substring deduplication by sliding sentence spans.

A sentence ends at a line end or at ``.``, ``!`` or ``?`` before white space, and holds at
least one word (what has none belongs to the sentence before it). From every sentence
of a document starts a run of ``span`` consecutive sentences, or of as many more as it
takes to reach ``min_words`` words (two short answers that recur are no passage); only
where the document ends before that is there none. Every run is hashed (by its words,
A-Z in lower case, 128 bits). All runs of the corpus are joined by hash. The first place of a run, the smallest (id, text, position), stays;
sentences that any later place of a repeated run covers are removed from the text,
also when it lies in the same document. A sentence goes with the white space
after it.

With a ``window`` (words; off unless asked for) passages that hold no such run are
reached too, and sentences may be cut apart: those of at least ``min_words`` words are
cut into units before each word whose hash is the least of ``window`` neighbouring words,
so a passage is cut alike wherever it stands, also inside other sentences. Runs are of
units then. Units are removed instead of sentences, and ``n_removed`` counts sentences
that lost any.

1. A scan emits a row per run. A partial aggregate finds the runs that occur at
   two or more places and their first place; that table is written out.
2. The runs are joined with it. A very common run is one row on that side, so
   Spark can split its rows over tasks; nothing gathers a run's places.
3. The places to remove, gathered per document, meet the texts.

Defined results: a null text is empty and stays null; a document of fewer than
``span`` sentences has no run; rows that repeat an id and a text are one document
(nothing of them is removed for each other's sake), rows of one id with other
texts are documents of their own; a null id counts as one id after all others; an
empty table gives an empty result; input columns named ``n_sentences`` or
``n_removed`` are replaced and others kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_key, materialise, slices, without
from tidemark.llm.ngram_join import _mix, hash_run, hash_words

_STOP, _SPACE = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b".!?")] = True
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def sentences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start in its text, words, two hashes) of each sentence of all texts, and bounds of texts among them."""
    return units(texts)[:4]


def units(texts: list[bytes], window: int | None = None, min_words: int = 0):
    """As ``sentences``, with long ones cut if there is a ``window``, and each unit's sentence (counted through all texts)."""
    raw = [t.lower() for t in texts]                 # bytes: A-Z only, so places stay the same
    words, at, bounds, starts = hash_words(raw)
    if not len(words):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros((2, 0), np.uint64), np.zeros(len(texts) + 1, np.int64), none
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    ends = data == 10
    ends[:-1] |= _STOP[data[:-1]] & _SPACE[data[1:]]
    before = np.cumsum(ends) - ends                  # line and sentence ends before a place
    opens = np.ones(len(at), bool)
    opens[1:] = before[at[1:]] > before[at[:-1]]
    opens[bounds[:-1][bounds[:-1] < len(at)]] = True
    first = np.flatnonzero(opens)
    count = np.diff(np.append(first, len(words)))
    whole = first
    if window:
        first = _cuts(words, whole, count, window, min_words)
        count = np.diff(np.append(first, len(words)))
    place = np.arange(len(words)) - np.repeat(first, count)
    hashes = np.stack([np.add.reduceat(_mix(words + (place.astype(np.uint64) + np.uint64(s)) * np.uint64(0x9E3779B97F4A7C15)), first)
                       for s in (1, 1 << 40)])
    text = np.searchsorted(starts, at[first], side="right") - 1
    return (at[first] - starts[text], count, hashes, np.searchsorted(first, bounds),
            np.searchsorted(whole, first, side="right") - 1)


def _cuts(words: np.ndarray, first: np.ndarray, count: np.ndarray, window: int, min_words: int) -> np.ndarray:
    """Places among ``words`` where units begin: sentences, and in long ones the least word of each window."""
    long = (count >= max(min_words, window)).nonzero()[0]
    own = np.repeat(count[long], count[long])
    place = np.arange(len(own)) - np.repeat(np.cumsum(count[long]) - count[long], count[long])
    at = np.repeat(first[long], count[long]) + place
    at = at[place + window <= own]                  # where a whole window starts
    if not len(at):
        return first
    views = np.lib.stride_tricks.sliding_window_view(_mix(words), window)
    least = np.concatenate([part + views[part].argmin(axis=1) for part in np.array_split(at, len(at) // 100_000 + 1)])
    return np.union1d(first, least)


def _runs(texts: list[bytes], span: int, min_words: int, window: int | None = None):
    """(text, position, units, two hashes) of each run of sentences or units with enough words."""
    _, count, hashes, bounds, _ = units(texts, window, min_words)
    n = len(count)
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((2, 0), np.uint64)
    per = np.diff(bounds)
    text = np.repeat(np.arange(len(texts)), per)
    position = np.arange(n) - np.repeat(bounds[:-1], per)
    total = np.cumsum(np.append(0, count))
    last = np.minimum(np.arange(n) + span, n)
    last = np.maximum(last, np.searchsorted(total, total[:n] + min_words))
    ok = (np.arange(n) + span <= last) & (last <= bounds[1:][text])
    held = last - np.arange(n)
    two = np.zeros((2, n), np.uint64)
    for k in np.unique(held[ok]):
        mine = ok & (held == k)
        for one, salt, h in zip(two, (0, 99), hashes):
            one[mine] = _mix(hash_run(_mix(h), int(k), salt))[mine]
    return text[ok], position[ok], held[ok], two[:, ok]


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 2,
                min_words: int = 13, window: int | None = None) -> DataFrame:
    """``docs`` without repeated sentence runs, plus ``n_sentences`` and ``n_removed``."""
    docs = without(docs, ["n_sentences", "n_removed"])
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({"tm_id": id_key(id_col), "tm_hash": F.xxhash64(text)})

    def emit(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.large_binary()).to_pylist()]
            for a, b in slices([len(t) for t in texts]):
                at, position, held, (one, two) = _runs(texts[a:b], span, min_words, window)
                at = pa.array(at + a)
                yield pa.RecordBatch.from_pydict({
                    "tm_id": batch.column(0).take(at), "tm_hash": batch.column(1).take(at),
                    "position": pa.array(position.astype(np.int32)), "units": pa.array(held.astype(np.int32)), "h1": pa.array(one.view(np.int64)), "h2": pa.array(two.view(np.int64))})

    runs = keyed.select("tm_id", "tm_hash", text).mapInArrow(emit, "tm_id long, tm_hash long, position int, units int, h1 long, h2 long")
    place = F.struct("tm_id", "tm_hash", "position")
    repeated = materialise(runs.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                           .filter("first < last").select("h1", "h2", "first"), "span-repeats")
    later = runs.join(repeated, ["h1", "h2"]).filter(place > F.col("first"))
    gone = later.groupBy("tm_id", "tm_hash").agg(F.collect_set(F.struct("position", "units")).alias("tm_gone"))

    def cut(batches):
        for batch in (x.slice(a, b - a) for x in batches for a, b in slices(
                pc.fill_null(pc.binary_length(x.column(x.schema.get_field_index(text_col))), 0).to_pylist())):
            names = batch.schema.names
            at = names.index(text_col)
            texts = batch.column(at).cast(pa.large_binary()).to_pylist()
            starts, _, _, bounds, whole = units([t or b"" for t in texts], window, min_words)
            kept, removed = [], []
            held = [len(np.unique(whole[a:b])) for a, b in zip(bounds[:-1], bounds[1:])]
            for i, (t, runs_) in enumerate(zip(texts, batch.column(names.index("tm_gone")).to_pylist())):
                if not runs_:
                    kept.append(t), removed.append(0)
                    continue
                own = starts[bounds[i]:bounds[i + 1]]
                lost = np.zeros(len(own), bool)
                for r in runs_:
                    lost[r["position"]:r["position"] + r["units"]] = True
                ends = np.append(own[1:], len(t))
                kept.append(t[:own[0]] + b"".join(t[a:b] for a, b, x in zip(own, ends, lost) if not x))
                removed.append(len(np.unique(whole[bounds[i]:bounds[i + 1]][lost])))
            stay = [i for i, n in enumerate(names) if n not in ("tm_id", "tm_hash", "tm_gone")]
            columns = [pa.array(kept, pa.binary()).cast(pa.string()) if i == at else batch.column(i) for i in stay]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(held, pa.int64()), pa.array(removed, pa.int64())],
                names=[*[names[i] for i in stay], "n_sentences", "n_removed"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return keyed.join(gone, ["tm_id", "tm_hash"], "left").mapInArrow(cut, f"{fields}, n_sentences long, n_removed long")
