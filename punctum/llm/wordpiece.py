"""Numbers of word pieces by longest match, from an automaton that never builds the pieces."""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from punctum.llm.common import chunks, raw

BLOCK_BYTES = 8 << 20
#: Words that are still read in step; a round of array operations costs about as much as this many steps one by one.
FEW = 256


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a rank file (base64 and number on a line) that can stand in a word: no white space but one leading space."""
    with open(path, "rb") as lines:
        pieces = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    return [p for p in pieces if p and not any(c in b"\t\n\r\x0b\x0c " for c in p[1:]) and p[:1] not in (b"\t", b"\n", b"\r", b"\x0b", b"\x0c")]


class Automaton:
    """Trie of the pieces with failure links.

    ``popped[v]`` is the number of pieces that longest match has for sure when it leaves node v, and
    ``fail[v]`` the node of what it has read since, -1 if it can't be cut into pieces.
    """

    def __init__(self, pieces: Iterable[bytes]):
        children: list[dict[int, int]] = [{}]
        ends = set()
        for piece in pieces:
            node = 0
            for byte in piece:
                after = children[node].get(byte)
                if after is None:
                    after = children[node][byte] = len(children)
                    children.append({})
                node = after
            ends.add(node)
        fail, popped, queue = [-1] * len(children), [0] * len(children), [0]
        for node in queue:
            for byte, child in children[node].items():
                queue.append(child)
                if child in ends:
                    fail[child], popped[child] = 0, 1
                    continue
                at, pops = fail[node], popped[node]
                while at >= 0 and byte not in children[at]:
                    pops, at = pops + popped[at], fail[at]
                if at >= 0:
                    fail[child], popped[child] = children[at][byte], pops
        keys = [(node << 8 | byte, child) for node, edges in enumerate(children) for byte, child in edges.items()]
        keys.sort()
        self.keys, self.next = np.array([k for k, _ in keys], np.int64), np.array([c for _, c in keys], np.int32)
        self.fail, self.popped = np.array(fail, np.int32), np.array(popped, np.int32)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Child nodes, -1 where there is none."""
        key = node.astype(np.int64) << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.next[at], -1)

    @cached_property
    def edges(self) -> tuple[dict[int, int], list[int], list[int]]:
        """The automaton for steps one by one; made where it is needed, so it isn't sent."""
        return dict(zip(self.keys.tolist(), self.next.tolist())), self.fail.tolist(), self.popped.tolist()

    def walk(self, text: bytes, node: int, pieces: int) -> int:
        """Number of pieces of a word whose rest is ``text``, read from ``node`` after ``pieces`` pieces; 1 if it has no cover."""
        edges, fail, popped = self.edges
        for byte in text:
            after = edges.get(node << 8 | byte)
            while after is None:
                pieces += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
                after = edges.get(node << 8 | byte)
            node = after
        while node > 0:
            pieces += popped[node]
            node = fail[node]
        return 1 if node < 0 else pieces

    def lengths(self, words: list[bytes], few: int = FEW) -> np.ndarray:
        """Number of pieces of each word; 1 for a word that has no cover.

        All words go in step, byte by byte, until fewer than ``few`` go on; these are walked one by one from where they are,
        so the time follows the bytes, however long one word is.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-size, kind="stable")
        text = np.frombuffer(b"".join(words), np.uint8)
        begin = (np.cumsum(size) - size)[order]
        size, node, pieces = size[order], np.zeros(len(words), np.int32), np.zeros(len(words), np.int64)
        lost = np.zeros(len(words), bool)
        for at in range(int(size[0]) if len(size) else 0):
            live = np.flatnonzero(~lost[: np.searchsorted(-size, -at, side="left")])
            if len(live) < few:
                for i in live.tolist():
                    rest = text[begin[i] + at : begin[i] + size[i]].tobytes()
                    pieces[i], node[i] = self.walk(rest, int(node[i]), int(pieces[i])), 0
                break
            byte = text[begin[live] + at]
            while len(live):
                after = self.step(node[live], byte)
                node[live[after >= 0]] = after[after >= 0]
                live, byte = live[after < 0], byte[after < 0]
                pieces[live] += self.popped[node[live]]
                node[live] = self.fail[node[live]]
                gone = node[live] < 0
                lost[live[gone]] = True
                live, byte = live[~gone], byte[~gone]
        live = np.flatnonzero(~lost & (node > 0))
        while len(live):
            pieces[live] += self.popped[node[live]]
            node[live] = self.fail[node[live]]
            lost[live[node[live] < 0]] = True
            live = live[node[live] > 0]
        result = np.empty(len(words), np.int64)
        result[order] = np.where(lost, 1, pieces)
        return result


def token_counts(docs: DataFrame, path: str = "/opt/tokenizers/byte_bpe_50k.tiktoken") -> DataFrame:
    """``doc_id, n_words, n_tokens``, one row for each row of ``docs``.

    A word is a run without ASCII white space; it is cut, with a space before it, into the longest
    piece of the vocabulary again and again. A word that can't be cut so counts as one token. Null and
    empty texts have no tokens. The driver reads the vocabulary; the automaton, as large as the
    vocabulary and no larger, is broadcast. Only ``doc_id`` and ``text`` are read.
    """
    automaton = docs.sparkSession.sparkContext.broadcast(Automaton(vocabulary(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, limit=BLOCK_BYTES):
            number: dict[bytes, int] = defaultdict(count().__next__)
            places, sizes = [], []
            for text in raw(batch.column("text")):
                words = text.split()
                places.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
                sizes.append(len(words))
            lengths = automaton.value.lengths([b" " + w for w in number])
            total = np.concatenate(([0], np.cumsum(lengths[np.concatenate(places)])))
            ends = np.cumsum(sizes)
            tokens = total[ends] - total[ends - np.array(sizes)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_tokens long")
