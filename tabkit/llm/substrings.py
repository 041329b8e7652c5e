"""Repeated-phrase removal with sharded Aho-Corasick automata.

Words are runs ``[^\\x20\\x09-\\x0D]+``, a window is ``width`` consecutive words of one
document. A word goes if a window covers it whose word sequence also starts in a document
with a smaller doc_id, so that the first document keeps a passage.

Candidates come from ``anchors``. In a shard the recurring windows are confirmed word by
word, each distinct one becomes a pattern of one automaton (each distinct word of the shard
stands for one character), and all segments of the shard's anchors, from every document,
stream through it: every occurrence is located with the smallest doc_id of its phrase.
Shards are bounded in bytes, and so are the automata.

Defined results: a NULL or empty text has no words. A NULL doc_id counts as larger than all
others; rows with equal ids do not take words from each other. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, functions as F

from tabkit.llm import anchors
from tabkit.llm.common import NULL_ID, mix, window_hash

WIDTH, GRAM = 13, 4
#: Content bytes of one shard.
SHARD_BYTES = 1 << 19


#: The word that parts the contents of a shard: no word holds a line break.
PARTING = b"\n"


def letters(ids: np.ndarray) -> str:
    """A character for each word number, leaving out the surrogates."""
    return (ids + 1 + np.where(ids + 1 < 0xD800, 0, 0x800)).astype("<u4").tobytes().decode("utf-32-le")


def locate(contents: list[bytes], lowest, highest, width: int = WIDTH) -> list[bytes | None]:
    """For each content (words joined by a space; the lowest and highest id it occurs in) the
    runs (first window, windows, smallest id) of the phrases found in several documents."""
    known: dict[bytes, int] = {PARTING: 0}
    number = known.setdefault
    ids = np.array([number(w, len(known)) for w in (b" %b " % PARTING).join(contents).split(b" ")], np.int64)
    text = letters(ids)
    ends = np.append(np.flatnonzero(ids == 0), len(ids))
    begins = np.append(0, ends[:-1] + 1)
    count = np.maximum(ends - begins - width + 1, 0)  # windows of each content
    line = np.repeat(np.arange(len(contents)), count)
    at = begins[line] + np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)
    if not len(at):
        return [None] * len(contents)
    # windows with equal words have equal hashes: only those whose hash is in several documents are compared
    _, group = np.unique(window_hash(mix(ids.astype(np.uint64)), width)[at], return_inverse=True)
    order = np.argsort(group, kind="stable")
    first = np.searchsorted(group[order], np.arange(group.max() + 1))
    shared = np.minimum.reduceat(lowest[line][order], first) < np.maximum.reduceat(highest[line][order], first)
    some = shared[group]
    low: dict[str, int] = {}
    high: dict[str, int] = {}
    for i, lo, hi in zip(at[some].tolist(), lowest[line[some]].tolist(), highest[line[some]].tolist()):
        phrase = text[i: i + width]
        if phrase in low:
            low[phrase], high[phrase] = min(low[phrase], lo), max(high[phrase], hi)
        else:
            low[phrase], high[phrase] = lo, hi
    automaton = ahocorasick.Automaton()
    for phrase, lo in low.items():
        if lo < high[phrase]:
            automaton.add_word(phrase, lo)
    if not len(automaton):
        return [None] * len(contents)
    automaton.make_automaton()
    met = np.fromiter(chain.from_iterable(automaton.iter(text)), np.int64).reshape(-1, 2)
    where, value = met[:, 0] - width + 1, met[:, 1]
    # the parting word lies between two contents: no window follows one of another content directly
    new = np.ones(len(where), bool)
    new[1:] = (where[1:] != where[:-1] + 1) | (value[1:] != value[:-1])
    run = np.flatnonzero(new)
    own = np.searchsorted(begins, where[run], "right") - 1
    told = np.stack([where[run] - begins[own], np.diff(np.append(run, len(where))), value[run]], axis=1).astype(np.int64)
    cuts = np.searchsorted(own, np.arange(len(contents) + 1)).tolist()
    return [told[a:b].tobytes() if a < b else None for a, b in zip(cuts, cuts[1:])]


def answered(contents: list[bytes], lowest, highest, anchor: np.ndarray, width: int = WIDTH) -> list[bytes | None]:
    """``locate`` of a shard, without anchors that lie in one document only: no phrase of theirs is in another."""
    _, index = np.unique(anchor, return_inverse=True)
    low, high = np.full(index.max() + 1, np.iinfo(np.int64).max), np.full(index.max() + 1, np.iinfo(np.int64).min)
    np.minimum.at(low, index, lowest)
    np.maximum.at(high, index, highest)
    shared = np.flatnonzero((low < high)[index])
    out: list[bytes | None] = [None] * len(contents)
    if len(shared):
        for i, runs in zip(shared.tolist(), locate([contents[i] for i in shared], lowest[shared], highest[shared], width)):
            out[i] = runs
    return out


def drop_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs``."""
    rows = anchors.keyed(docs)
    found = anchors.with_segments(rows, "word", width, gram)
    told = anchors.answers(
        found, "word", width, lambda contents, lowest, highest, copies, anchor: answered(contents, lowest, highest, anchor, width), SHARD_BYTES,
        lambda rel, lowest, highest, copies: anchors.runs_of(rel[lowest < highest], lowest[lowest < highest]))

    def finish(did, text, hits):
        words = text.split()
        lo, runs = hits
        lo, runs = (x[runs[:, 2] < did] for x in (lo, runs))
        first, last = anchors.merged_spans(lo + runs[:, 0], lo + runs[:, 0] + runs[:, 1] - 1 + width)
        kept, at = [], 0
        for a, b in zip(first.tolist(), last.tolist()):
            kept += words[at:a]
            at = b
        kept += words[at:]
        return did, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    out = anchors.per_text(rows, found, told, finish, "did long, n_words long, n_removed long, kept_sha256 string")
    return out.select(F.nullif("did", F.lit(NULL_ID)).alias("doc_id"), "n_words", "n_removed", "kept_sha256")
