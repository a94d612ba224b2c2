"""Operator 4: byte-level BPE encoding and decoding with DuckDB queries inside each partition.

A partition's texts are cut into pieces; its distinct pieces go to an in-memory DuckDB of the Python
worker as rows (word, position, token), one per byte. A recursive query joins neighbouring rows with
the merge table and contracts, in each word, the leftmost pair of the lowest rank, until no pair of any
word is in the table. Decoding joins token rows with the vocabulary and puts their bytes together by an
ordered aggregation of each document's tokens.

Bounds: texts are handled in runs of ``RUN_BYTES``, words in runs of ``RUN_WORDS``, tokens to decode in runs of ``RUN_TOKENS``; the worker's table of
encoded pieces is emptied when it has ``KNOWN`` rows, which only costs time. Pieces above ``LONG`` bytes
are contracted in the same order with a heap instead, as the recursion copies a word at each step.

Defined results: a null text counts as empty and gives no token; repeated rows are encoded each; other
columns pass through untouched; a document's tokens depend on its text alone.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stockroom.llm.common import in_tasks, per_worker, slices, text_array
from stockroom.llm.pieces import distinct_pieces

RUN_BYTES, RUN_WORDS, RUN_TOKENS, KNOWN, LONG = 2 << 20, 16_000, 1 << 20, 400_000, 400
ENCODED = "doc_id long, n_tokens long, ids binary, decoded binary"

#: b packs the pair's merged id, the position of its left part and of its right part.
CONTRACT = """
WITH RECURSIVE step(iter, word, pos, tok) AS (
  SELECT 0, word, pos, tok FROM word_bytes
  UNION ALL
  SELECT iter + 1, s.word, s.pos, CASE WHEN s.pos = best.pos THEN best.merged ELSE s.tok END
  FROM step s JOIN (
    SELECT word, (b >> 40)::INT AS merged, ((b >> 20) & 1048575)::INT AS pos, (b & 1048575)::INT AS next_pos
    FROM (
      SELECT word, min((m.merged::BIGINT << 40) | (p.pos::BIGINT << 20) | p.next_pos) AS b
      FROM (SELECT word, pos, tok, lead(tok) OVER w AS next_tok, lead(pos) OVER w AS next_pos
            FROM step WINDOW w AS (PARTITION BY word ORDER BY pos)) p
      JOIN merges m ON m.left_tok = p.tok AND m.right_tok = p.next_tok
      GROUP BY word)) best ON best.word = s.word
  WHERE s.pos <> best.next_pos)
SELECT word, list(tok ORDER BY pos) AS ids
FROM step JOIN (SELECT word, max(iter) AS iter FROM step GROUP BY word) USING (word, iter)
GROUP BY word
"""

#: Pieces are small binaries; a document's list of them, in order, is its bytes.
DECODE = """
SELECT doc, list(piece ORDER BY pos) AS pieces
FROM tokens JOIN vocabulary USING (tok)
GROUP BY doc ORDER BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merge_rows(ranks: dict[bytes, int]) -> tuple[list[int], list[int], list[int]]:
    """All pairs of tokens whose bytes together are a token: left, right, merged."""
    left, right, merged = [], [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a), right.append(b), merged.append(rank)
    return left, right, merged


class Codec:
    """Encoder and decoder of one Python worker for one rank file."""

    def __init__(self, path: str):
        import duckdb

        self.ranks = read_ranks(path)
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1; SET memory_limit = '160MB'; SET preserve_insertion_order = false")
        left, right, merged = (pa.array(x, pa.int32()) for x in merge_rows(self.ranks))
        self._table("merges", pa.table({"left_tok": left, "right_tok": right, "merged": merged}))
        tokens = sorted(self.ranks, key=self.ranks.get)
        self._table("vocabulary", pa.table({"tok": pa.array([self.ranks[t] for t in tokens], pa.int32()), "piece": pa.array(tokens, pa.large_binary())}))
        self._empty()

    def _table(self, name: str, rows: pa.Table) -> None:
        self.db.register("incoming", rows)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.db.unregister("incoming")

    def _arrow(self, query: str) -> pa.Table:
        return self.db.sql(query).to_arrow_table()

    def _empty(self) -> None:
        self.db.execute("CREATE OR REPLACE TABLE known AS SELECT piece, [tok] AS ids FROM vocabulary")
        self.rows = len(self.ranks)

    def _heap(self, piece: bytes) -> list[int]:
        """The contraction order of the query for one long piece, in O(n log n) steps."""
        tok = [int(self.byte_ids[b]) for b in piece]
        merged = per_worker(("llm merges", id(self)), lambda: {(a, b): m for a, b, m in zip(*merge_rows(self.ranks))})
        n = len(tok)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(merged[p], i) for i, p in enumerate(zip(tok, tok[1:])) if p in merged]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if tok[i] < 0 or j < 0 or merged.get((tok[i], tok[j])) != rank:
                continue
            tok[i], tok[j] = rank, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (m := merged.get((tok[a], tok[b]))) is not None:
                    heapq.heappush(heap, (m, a))
        return [t for t in tok if t >= 0]

    def _learn(self, words: pa.Array) -> None:
        """Encode distinct new pieces and keep them in ``known``."""
        sizes = np.diff(np.asarray(words.buffers()[1]).view(np.int64)[words.offset : words.offset + len(words) + 1])
        for i in np.flatnonzero(sizes > LONG):
            self.db.execute("INSERT INTO known VALUES (?, ?)", [words[int(i)].as_py(), self._heap(words[int(i)].as_py())])
        words, sizes = words.filter(pa.array(sizes <= LONG)), sizes[sizes <= LONG]
        for start in range(0, len(words), RUN_WORDS):
            part, lens = words.slice(start, RUN_WORDS), sizes[start : start + RUN_WORDS]
            joined = np.frombuffer(b"".join(part.to_pylist()), np.uint8)
            ends = np.cumsum(lens)
            word = np.repeat(np.arange(len(part), dtype=np.int32), lens)
            pos = (np.arange(len(joined)) - np.repeat(ends - lens, lens)).astype(np.int32)
            self.db.register("word_bytes", pa.table({"word": word, "pos": pos, "tok": self.byte_ids[joined]}))
            self.db.register("words", pa.table({"word": np.arange(len(part), dtype=np.int32), "piece": part}))
            self.db.execute(f"INSERT INTO known SELECT piece, ids FROM words JOIN ({CONTRACT}) USING (word)")

    def ids_of(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of distinct pieces, joined, and the n + 1 offsets of the pieces in them."""
        if self.rows > KNOWN:
            self._empty()
        self.db.register("asked", pa.table({"n": np.arange(len(distinct)), "piece": distinct}))
        new = self._arrow("SELECT piece FROM asked ANTI JOIN known USING (piece)")["piece"]
        if len(new):
            self._learn(pa.concat_arrays(new.chunks).cast(pa.large_binary()))
            self.rows += len(new)
        ids = self._arrow("SELECT ids FROM asked JOIN known USING (piece) ORDER BY n")["ids"].combine_chunks()
        return ids.flatten().to_numpy(), ids.offsets.to_numpy().astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of all texts (a binary array), joined, and the n + 1 offsets of the texts in them."""
        distinct, number, offsets = distinct_pieces(texts)
        if not len(number):
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        ids, at = self.ids_of(distinct)
        sizes = np.diff(at)[number]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids[np.repeat(at[number] - ends[:-1], sizes) + np.arange(ends[-1])], ends[offsets]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids: the tokens join the vocabulary, and each run's pieces are put together in order."""
        doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        parts: list[list[bytes]] = [[] for _ in offsets[1:]]
        for start in range(0, len(ids), RUN_TOKENS):
            run = slice(start, start + RUN_TOKENS)
            pos = np.arange(len(doc[run]), dtype=np.int32)
            self.db.register("tokens", pa.table({"doc": doc[run], "pos": pos, "tok": ids[run].astype(np.int32)}))
            for rows in self._arrow(DECODE).to_batches():
                lists = rows.column("pieces")
                pieces = lists.flatten().cast(pa.large_binary())
                cuts = np.asarray(pieces.buffers()[1]).view(np.int64)[pieces.offset : pieces.offset + len(pieces) + 1]
                ends = cuts[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
                body = pieces.buffers()[2]
                for d, a, b in zip(rows.column("doc").to_pylist(), ends, ends[1:]):
                    parts[d].append(body[a:b].to_pybytes())
        return [b"".join(p) for p in parts]


def codec(path: str) -> Codec:
    return per_worker(("llm codec", path), lambda: Codec(path))


def encoded(docs: DataFrame, ranks_path: str, digest: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) of every row: ids as little-endian unsigned 32-bit integers and the
    bytes decoded from them, or with ``digest`` the SHA-256 of both in lowercase hex."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = codec(ranks_path)
        for batch in batches:
            for part in slices(batch, most=RUN_BYTES):
                ids, at = one.encode(text_array(part.column("text")))
                spelled = one.decode(ids, at)
                raw = [ids[a:b].astype("<u4").tobytes() for a, b in zip(at, at[1:])]
                if digest:
                    raw, spelled = ([hashlib.sha256(x).hexdigest() for x in xs] for xs in (raw, spelled))
                kind = pa.string() if digest else pa.binary()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(at)), pa.array(raw, kind), pa.array(spelled, kind)],
                    names=["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded"))],
                )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else ENCODED
    return in_tasks(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, schema)
