"""SentencePiece encoding that keeps byte offsets, and decoding.

1. The text is normalised by the model's compiled character map: at each place the
   longest prefix that the map's double-array trie holds is replaced, any other
   character stays. With every normalised character goes the byte of the source
   where its prefix starts. Dummy prefix, space escaping and the removal of extra
   spaces follow the model's settings.
2. The normalised text is cut where no piece of the vocabulary can reach over: after
   and before characters that no longer piece holds, and before the space symbols of
   a word if no piece has them behind another character. So each chunk is merged
   alone, and chunks seen before come from a cache of bounded size.
3. In a chunk the adjacent pair that makes the piece of highest score is merged, the
   leftmost of equal ones, until none makes a piece. Characters without a piece
   become the byte pieces of their UTF-8 form.
4. Each piece is projected to the source bytes from where its first character comes
   to where the next piece's does. Of a character's byte pieces the last one holds
   its bytes, those before it are empty at its start.

The model is a parameter (a file's bytes); it must be a BPE model with byte fallback
and without user-defined symbols, else ``ValueError``. It is broadcast: its size is
that of a vocabulary, whatever the number of texts.

Defined cases: a NULL or empty text has no pieces and decodes to the empty text;
repeated rows get equal rows; ids are returned as they are, NULL too; an empty table
gives no rows; other columns are ignored by ``encode`` and kept by ``with_decoded``,
which raises ``ValueError`` if the name of its new column is taken. Whole texts are
encoded, one at a time.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldnotes.llm.util import Shared, slices, table

SPACE = "▁"  # stands for a space in pieces
CACHED = 1 << 18  # chunks that a task remembers, besides those of the texts at hand
SLICE = 2 << 20  # bytes of text that are encoded at once
ROWS = 256  # that are decoded at once
SHORT = 64  # characters; longer chunks are merged one by one

# Fixed values of the model file's format: kinds of pieces and the kind of model.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message: whole numbers, or bytes of all other fields."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        field, wire = divmod(number(), 8)
        if wire == 0:
            yield field, number()
        else:
            size = number() if wire == 2 else {1: 8, 5: 4}[wire]
            yield field, data[at : at + size]
            at += size


class CharMap:
    """A compiled character map: a double-array trie of prefixes, and their replacements."""

    def __init__(self, blob: bytes) -> None:
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.texts = blob[4 + size :]
        self.known: dict[str, tuple[str, int] | None] = {}

    def walk(self, data: bytes) -> tuple[int, int, bool]:
        """(bytes of the longest prefix of ``data`` in the trie, place of its replacement, whether the walk ended before ``data`` did)."""
        offset = lambda unit: (unit >> 10) << ((unit & 0x200) >> 6)
        node, best, text = offset(self.units[0]), 0, 0
        for i, byte in enumerate(data):
            unit = self.units[node ^ byte]
            if unit & 0x800000FF != byte:
                return best, text, True
            node ^= byte ^ offset(unit)
            if unit & 0x100:
                best, text = i + 1, self.units[node] & 0x7FFFFFFF
        return best, text, False

    def replacement(self, text: str, at: int) -> tuple[str, int]:
        """What the characters from ``at`` become, and how many characters that takes."""
        width = 2
        while True:  # a walk that ends within the characters at hand depends on these alone
            near = text[at : at + width]
            found = self.known.get(near)
            if found:
                return found
            size, place, ended = self.walk(near.encode())
            if ended or at + width >= len(text):
                if not size:
                    found = near[0], 1
                else:
                    found = self.texts[place : self.texts.index(b"\0", place)].decode(), len(near.encode()[:size].decode())
                if ended and len(self.known) < CACHED:
                    self.known[near] = found
                return found
            width *= 2


class Model:
    """A BPE model with byte fallback, read from the bytes of its file."""

    def __init__(self, data: bytes) -> None:
        fields = list(message(data))
        trainer = dict(x for f, v in fields if f == 2 for x in message(v))
        rules = dict(x for f, v in fields if f == 3 for x in message(v))
        if trainer.get(3, 1) != BPE or not trainer.get(35, 0):
            raise ValueError("not a BPE model with byte fallback")
        if trainer.get(24, 0):
            raise ValueError("models with spaces as suffixes are not supported")
        self.char_map = CharMap(rules.get(2, b""))
        self.dummy, self.remove_extra, self.escape = (bool(rules.get(i, 1)) for i in (3, 4, 5))
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        pieces = [dict(message(v)) for f, v in fields if f == 1]
        self.pieces = [p[1].decode() for p in pieces]
        self.kinds = [p.get(3, NORMAL) for p in pieces]
        if {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.forget()
        self.scores = [struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0] for p in pieces]

    @cached_property
    def ids(self) -> dict[str, int]:
        return {p: i for i, (p, kind) in enumerate(zip(self.pieces, self.kinds)) if kind == NORMAL}

    @cached_property
    def bytes_at(self) -> list[int]:
        """Id of each byte's piece."""
        at = {int(p[1:-1], 16): i for i, (p, kind) in enumerate(zip(self.pieces, self.kinds)) if kind == BYTE}
        return [at[b] for b in range(256)]

    @cached_property
    def chunks_of(self) -> Callable[[str], list[str]]:
        """Cuts a normalised text where no piece reaches over: between characters of groups that no piece mixes, and before spaces."""
        longer = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in longer):
            return lambda text: [text] if text else []
        group: dict[str, str] = {}

        def top(c: str) -> str:
            while group.setdefault(c, c) != c:
                group[c] = c = group[group[c]]
            return c

        for p in longer:
            p = p.lstrip(SPACE)
            for x, y in zip(p, p[1:] or p):
                group[top(x)] = top(y)
        groups = defaultdict(list)
        for c in sorted(group):
            groups[top(c)].append(re.escape(c))
        many = sorted((g for g in groups.values() if len(g) > 1), key=len, reverse=True)
        alone = [g[0] for g in groups.values() if len(g) == 1]
        kinds = [f"{SPACE}*[{''.join(g)}]+" for g in many] + [f"{SPACE}*[{''.join(alone)}]"] * bool(alone)
        return re.compile("(?s)" + "|".join([*kinds, f"{SPACE}+", "."])).findall

    @cached_property
    def joins(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the pairs of symbols that make a piece, the rank of each (0: highest score), the piece, and each character's symbol."""
        ids = dict(self.ids)
        for p in self.ids:
            for c in p:  # a character that is no piece itself
                ids.setdefault(c, len(self.pieces) + len(ids))
        symbol = -1 - np.arange(0x110000)  # characters without a piece, to be spelt in bytes
        for c, i in ids.items():
            if len(c) == 1:
                symbol[ord(c)] = i
        rank = {x: i for i, x in enumerate(sorted(set(self.scores), reverse=True))}
        made = sorted((ids[p[:i]] << 32 | ids[p[i:]], rank[self.scores[k]], k) for p, k in self.ids.items() for i in range(1, len(p)) if p[:i] in ids and p[i:] in ids)
        keys, ranks, products = np.array(made or [(-1, 0, 0)], np.int64).T
        return np.ascontiguousarray(keys), np.ascontiguousarray(ranks), np.ascontiguousarray(products), symbol

    def merged_all(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all chunks, one after another, and how many each has. In every round each chunk merges its best pair."""
        none = np.int64(1 << 40)
        keys, ranks, products, symbol = self.joins
        sym = symbol[np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)]
        owner = np.repeat(np.arange(len(chunks)), np.fromiter(map(len, chunks), np.int64, len(chunks)))
        rank, product = np.full(len(sym), none), np.zeros(len(sym), np.int64)  # of each symbol with the next one
        symbols, owners = [sym[:0]], [owner[:0]]

        def look(at: np.ndarray) -> None:
            key = sym[at] << 32 | sym[at + 1]
            i = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            ok = (keys[i] == key) & (sym[at] >= 0) & (sym[at + 1] >= 0)
            rank[at], product[at] = np.where(ok, ranks[i], none), products[i]

        look(np.flatnonzero(owner[1:] == owner[:-1]))
        while len(sym):
            start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            low = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.append(start, len(sym))))
            done = low == none
            if done.any():
                symbols.append(sym[done])
                owners.append(owner[done])
                left = ~done
                sym, owner, rank, product, low = sym[left], owner[left], rank[left], product[left], low[left]
            at = np.flatnonzero(rank == low)
            if not len(at):
                break
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]  # the leftmost
            sym[at] = product[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, owner, rank, product = sym[keep], owner[keep], rank[keep], product[keep]
            at = at - np.arange(len(at))
            rank[at] = none
            changed = np.concatenate([at[at > 0] - 1, at])
            changed = changed[changed + 1 < len(sym)]
            look(changed[owner[changed] == owner[changed + 1]])
        owner = np.concatenate(owners)
        return np.concatenate(symbols)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(chunks))

    def spelt(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks, one after another, and how many each has: symbols without a piece become bytes."""
        sym, size = self.merged_all(chunks)
        odd = np.flatnonzero((sym < 0) | (sym >= len(self.pieces)))
        if not len(odd):
            return sym, size
        owner = np.repeat(np.arange(len(chunks)), size)
        chars = self.joins_chars
        spellings = [[self.bytes_at[b] for b in chars(int(s)).encode()] for s in sym[odd]]
        many = np.ones(len(sym), np.int64)
        many[odd] = list(map(len, spellings))
        ids = np.repeat(sym, many)
        first = np.cumsum(many) - many
        for f, ids_of in zip(first[odd].tolist(), spellings):
            ids[f : f + len(ids_of)] = ids_of
        return ids, np.bincount(owner, many, len(chunks)).astype(np.int64)

    @cached_property
    def joins_chars(self) -> Callable[[int], str]:
        """The character of a symbol that is no piece."""
        symbol = self.joins[3]
        known = {int(symbol[c]): chr(c) for c in np.flatnonzero(symbol >= len(self.pieces))}
        return lambda s: chr(-1 - s) if s < 0 else known[s]

    def merged(self, chunk: str) -> list[int]:
        """Ids of one chunk of any length, its best pair merged first."""
        ids, scores = self.ids, self.scores
        parts: list[str | None] = list(chunk)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs: list[tuple[float, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            piece = ids.get(parts[i] + parts[j])
            if piece is not None:
                heapq.heappush(pairs, (-scores[piece], i, j, len(parts[i]) + len(parts[j])))

        for i in range(n - 1):
            offer(i, i + 1)
        while pairs:
            _, i, j, size = heapq.heappop(pairs)
            if parts[i] is None or parts[j] is None or len(parts[i]) + len(parts[j]) != size:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        out: list[int] = []
        for p in parts:
            if p is not None:
                out += [ids[p]] if p in ids else [self.bytes_at[b] for b in p.encode()]
        return out

    def ids_of(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different chunks, one after another, and how many each has; those of before come from the cache."""
        if len(self.cache) > CACHED:
            self.forget()
        new = [c for c in chunks if c not in self.cache]
        short = [c for c in new if len(c) <= SHORT]
        ids, size = self.spelt(short)
        long = [self.merged(c) for c in new if len(c) > SHORT]
        self.cache.update(zip([*short, *(c for c in new if len(c) > SHORT)], range(len(self.cache), len(self.cache) + len(new))))
        self.held = np.concatenate([self.held, ids.astype(np.int32), *(np.array(x, np.int32) for x in long)])
        self.sizes = np.concatenate([self.sizes, size, np.array(list(map(len, long)), np.int64)])
        at = np.fromiter(map(self.cache.__getitem__, chunks), np.int64, len(chunks))
        return ragged(self.held, np.cumsum(self.sizes) - self.sizes, self.sizes, at), self.sizes[at]

    def forget(self) -> None:
        """Empties the cache: each chunk's place in ``sizes``, whose ids lie one after another in ``held``."""
        self.cache: dict[str, int] = {}
        self.held, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the source byte of each of its characters and of its end."""
        if not text:
            return "", np.zeros(1, np.int64)
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        source = np.zeros(len(code) + 1, np.int64)  # byte of each character of the text
        np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000).astype(np.int64), out=source[1:])
        space = SPACE if self.escape else " "
        if not self.char_map.units and not self.remove_extra:
            lead = space if self.dummy else ""
            return lead + text.replace(" ", space), source if not lead else np.concatenate([source[:1], source])
        out, at, i, n = [], [], 0, len(text)

        def step() -> tuple[str, int]:
            return self.char_map.replacement(text, i) if self.char_map.units else (text[i], 1)

        if self.remove_extra:
            while i < n and (found := step())[0] == " ":
                i += found[1]
            if i == n:
                return "", source[-1:]
        if self.dummy:
            out.append(" ")
            at.append(i)
        spaced = self.remove_extra
        while i < n:
            new, used = step()
            if spaced:
                new = new.lstrip(" ")
            out.append(new)
            at += [i] * len(new)
            if new:
                spaced = self.remove_extra and new.endswith(" ")
            i += used
        norm = "".join(out).replace(" ", space)
        if self.remove_extra:
            kept = len(norm.rstrip(space))
            i = at[kept] if kept < len(norm) else i
            norm, at = norm[:kept], at[:kept]
        return norm, source[np.array([*at, i], np.int64)]

    @cached_property
    def steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each id: characters, whether it is a byte, whether it is a byte within a character."""
        is_byte = np.array([kind == BYTE for kind in self.kinds])
        size = np.where(is_byte, 1, np.array([len(p) for p in self.pieces], np.int64))
        inner = np.zeros(len(size), bool)
        inner[self.bytes_at[0x80:0xC0]] = True
        return size, is_byte, inner

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The number of pieces of each text; the ids of all, one text after another, and the source bytes from and before which each stands."""
        normal = [self.normalised(t or "") for t in texts]
        chunks = [self.chunks_of(norm) for norm, _ in normal]
        coded = pa.array(list(chain.from_iterable(chunks)), pa.large_string()).dictionary_encode()
        code = coded.indices.to_numpy()
        ids, size = self.ids_of(coded.dictionary.to_pylist())
        all_ids, many = ragged(ids.astype(np.int32), np.cumsum(size) - size, size, code), size[code]
        ends = np.append(0, np.cumsum(many))[np.cumsum([0, *map(len, chunks)])]  # pieces before the end of each text
        chars, is_byte, inner = self.steps
        step = chars[all_ids]
        within = np.flatnonzero(inner[all_ids[1:]])
        step[within[is_byte[all_ids[within]]]] = 0  # the next piece is a byte of the same character
        source = np.concatenate([np.zeros(0, np.int64), *(x for _, x in normal)])
        end = np.cumsum(step) + np.repeat(np.arange(len(texts)), np.diff(ends))  # each text has one place more than characters
        return np.diff(ends), all_ids, source[end - step], source[end]

    @cached_property
    def contents(self) -> list[bytes]:
        text = {CONTROL: lambda p: "", UNKNOWN: lambda p: self.unknown_text}
        return [bytes([int(p[1:-1], 16)]) if kind == BYTE else text.get(kind, lambda p: p.replace(SPACE, " "))(p).encode()
                for p, kind in zip(self.pieces, self.kinds)]

    @cached_property
    def spellings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all pieces, one after another; where each piece's start and how many it has."""
        size = np.array(list(map(len, self.contents)), np.int64)
        return np.frombuffer(b"".join(self.contents), np.uint8), np.cumsum(size) - size, size

    def front(self, ids: np.ndarray) -> int:
        """Bytes that are taken from the front of the text of ``ids``: of space symbols."""
        taken = 0
        if self.dummy or self.remove_extra:
            for i in ids:
                starts = self.kinds[i] == NORMAL and self.pieces[i].startswith(SPACE)
                taken += starts
                if len(self.contents[i]) > starts or starts and not self.remove_extra:
                    break
        return taken

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ``ids``, of which each text's lie from one of ``ends`` to the next; bytes that are no UTF-8 become U+FFFD one by one."""
        contents, start, size = self.spellings
        data = ragged(contents, start, size, ids).tobytes()
        at = np.append(0, np.cumsum(size[ids]))[ends].tolist()
        ends = ends.tolist()
        return [data[a + self.front(ids[i:j]) : b].decode("utf-8", "one by one") for i, j, a, b in zip(ends, ends[1:], at, at[1:])]

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))[0]


def one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


def ragged(values: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches ``which`` of ``values``, one after another; stretch i has ``size[i]`` values from ``start[i]``."""
    many = size[which]
    ends = np.cumsum(many)
    return values[np.repeat(start[which] - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)]


def model_of(path: str) -> Model:
    """The model in a file that the driver reads."""
    with open(path, "rb") as f:
        return Model(f.read())


def encode(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, starts, ends) of every row: pieces, and the bytes of the UTF-8 text from and before which each stands."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shared = Shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in slices(batches, limit=SLICE):
            many, *columns = model.encode(b.column("text").to_pylist())
            offsets = pa.array(np.append(0, np.cumsum(many)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in columns]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *lists], ["doc_id", "ids", "starts", "ends"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, starts array<bigint>, ends array<bigint>")


def with_decoded(rows: DataFrame, model: Model, *, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids (NULL ids: the empty text) as the new column ``name``."""
    if name in rows.columns:
        raise ValueError(f"column {name!r} exists")
    shared = Shared(rows.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        codecs.register_error("one by one", one_by_one)
        for b in (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS)):
            lists = b.column(ids_col)
            many = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            texts = model.decode_all(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.append(0, np.cumsum(many, dtype=np.int64)))
            yield b.append_column(name, pa.array(texts, pa.string()))

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def op13_offset_pieces(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Digests of the pieces and of the decoded text of every document; n_bytes is where its last piece ends."""
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    model = model_of(model_path)
    pieces = encode(table(spark, sf_dir, "documents"), model)
    pieces = with_decoded(pieces.select("doc_id", "ids", F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(0)).cast("long").alias("n_bytes")), model)
    return pieces.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "n_bytes")
