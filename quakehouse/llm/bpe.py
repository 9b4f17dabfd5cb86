"""Op 6: BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can never be joined by a
merge, so a cut between its two bytes is certain. A text is cut at all such
pairs (white space is in no token, so every gap between words is one), the
fragments are encoded independently and their ids concatenated. Arrow splits a
batch of texts at ASCII white space and numbers its distinct chunks; each is encoded
once, and the texts' ids are gathered by those numbers. Words repeat over batches, so
each Python worker keeps tables of those it has seen, bounded in bytes.

The tokenizer file names its normaliser, its split pattern and its special
tokens; they are applied to one white-space-free chunk at a time, which gives
the ids of the whole text because no rule of the file looks across white space.

Defined results: a null or empty text has no ids and decodes to ''. Texts that
hold a special token's string get that token's id, as the library does. Rows
come back one for one in any order; columns of the input whose names clash with
the added ones are replaced.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain
from operator import concat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: what the tokenizer file calls white space (Unicode White_Space)
SPACE = "\t-\r \x85\xa0  -     　"
_SPACES = re.compile(f"[{SPACE}]+")
#: letters and marks that the normaliser only lowers, one by one
_LATIN = re.compile("[!-~À-ɏ]+")
#: bytes at which a worker's tables of chunks and words start anew, and what an entry takes beside its key and value
CACHE, ENTRY = 160_000_000, 160
#: input rows and bytes handled per output batch
ROWS, BYTES = 10_000, 12_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + n)
            n += 1
    return [out[b] for b in range(256)]


_SYMBOLS = dict(enumerate(byte_symbols()))
_BYTES = {c: b for b, c in _SYMBOLS.items()}


class ForcedBoundaryBPE:
    """Encoder and decoder for a word-end BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        whole = Tokenizer.from_file(path)
        self.normalize = whole.normalizer.normalize_str
        self.split = whole.pre_tokenizer.pre_tokenize_str
        self.end = models.BPE(vocab=self.vocab, merges=merges, end_of_word_suffix=self.suffix or None)
        self.inner = models.BPE(vocab=self.vocab, merges=merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.token = np.array([self.names.get(i, "") for i in range(max(self.names) + 1)], dtype=object)
        # pairs of adjacent symbols inside any token; the word end is no symbol of its own
        self.joined = {t[i:i + 2] for t in (x.removesuffix(self.suffix) for x in self.vocab)
                       for i in range(len(t) - 1)}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(pattern).findall
        # marks that the split pattern parts from the letters before them
        self.marks = {c for c in map(chr, [*range(33, 127), *range(192, 592)])
                      if not c.isalnum() and self.pattern(f"ab{c}") == ["ab", c]}
        self.joins = np.zeros((256, 256), bool)
        for x, y in self.joined:
            self.joins[_BYTES[x], _BYTES[y]] = True
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.held = 0

    def fragments(self, word: str) -> list[str]:
        """``word`` (in byte symbols) cut at every pair that no token holds."""
        if self.joined.issuperset(map(concat, word, word[1:])):
            return [word]
        cuts = [i + 1 for i in range(len(word) - 1) if word[i:i + 2] not in self.joined]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])]

    def learn(self, words: set[str]) -> None:
        """Enter the ids of words of the split pattern (in lower case; special tokens behind a line feed) in the table."""
        words = sorted(words)
        raw = np.frombuffer("\n".join(words).encode(), np.uint8)
        cut = ~self.joins[raw[:-1], raw[1:]] & (raw[:-1] != 10) & (raw[1:] != 10)
        cuts = set(np.cumsum(raw == 10)[:-1][cut].tolist()) if not any(w[0] == "\n" for w in words) else range(len(words))
        end, inner = self.end.tokenize, self.inner.tokenize
        for i, word in enumerate(words):
            if word[0] == "\n":
                found = [self.special[word[1:]]]
            else:
                last = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_SYMBOLS)
                found = []
                if i in cuts:
                    *first, last = self.fragments(last)
                    found = [t.id for f in first for t in inner(f)]
                found += [t.id for t in end(last)]
            ids = array("I", found).tobytes()
            self.held += ENTRY + len(word) + len(ids)
            self.words[word] = ids

    def parts(self, chunk: str) -> tuple[str, ...]:
        """The words (as ``learn`` takes them) of a text without ASCII white space."""
        if _LATIN.fullmatch(chunk) and "<" not in chunk:  # composed letters only: normalising is lowering each character
            low = chunk.lower()
            if low.isalpha():
                return (low,)
            if low[-1] in self.marks and low[:-1].isalpha():
                return (low[:-1], low[-1])
            return tuple(self.pattern(low))
        out = []
        for piece in _SPACES.split(chunk):
            for part in self.special_at.split(piece) if self.special_at and "<" in piece else (piece,):
                if part in self.special:
                    out.append("\n" + part)
                elif part:
                    out += [self.unsymbol(w) for w, _ in self.split(self.normalize(part))]
        return tuple(out)

    def unsymbol(self, word: str) -> str:
        """The text whose byte symbols are ``word``."""
        return bytes(map(_BYTES.__getitem__, word)).decode()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids (unsigned 32-bit) in a row, and where each text's begin, with the end; null texts have none."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        chunks = split.flatten().dictionary_encode()
        if self.held > CACHE:
            self.chunks, self.words, self.held = {}, {}, 0
        names = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [c for c in names if c not in self.chunks]
        parts = [self.parts(c) for c in new]
        self.learn(set(chain.from_iterable(parts)).difference(self.words))
        get = self.words.__getitem__
        found = [get(p[0]) if len(p) == 1 else b"".join(map(get, p)) for p in parts]
        self.chunks.update(zip(new, found))
        self.held += ENTRY * len(new) + sum(map(len, new)) + sum(map(len, found))
        known = [self.chunks[c] for c in names]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        index = chunks.indices.to_numpy(zero_copy_only=False)
        held = sizes[index]
        ends = np.cumsum(held)
        total = int(ends[-1]) if len(ends) else 0
        # an id's place in the distinct chunks' ids: its chunk's first, and how far it is from its chunk's start here
        at = np.arange(total) + np.repeat((np.cumsum(sizes) - sizes)[index] - (ends - held), held)
        words = np.concatenate(([0], np.cumsum(split.value_lengths().to_numpy(zero_copy_only=False))))
        return np.frombuffer(b"".join(known), "<u4")[at], np.concatenate(([0], ends))[words]

    def decode(self, ids: bytes) -> str:
        """The tokens' strings with a space between, as the file (which names no decoder) decodes."""
        return " ".join(self.token[np.frombuffer(ids, "<u4")].tolist())


_MODELS: dict[str, ForcedBoundaryBPE] = {}


def model(path: str) -> ForcedBoundaryBPE:
    """One encoder per worker process and file."""
    if path not in _MODELS:
        _MODELS[path] = ForcedBoundaryBPE(path)
    return _MODELS[path]


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ROWS rows and about BYTES of ``column``."""
    at = batch.schema.get_field_index(column)
    lens = pc.binary_length(batch.column(at)).fill_null(0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(lens):
        if i > start and (total + n > BYTES or i - start >= ROWS):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit) and, if named, the text decoded from them."""
    added = [T.StructField(ids, T.BinaryType())] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    keep = [f for f in docs.schema.fields if f.name not in (ids, decoded)]
    read = keep + ([] if text in [f.name for f in keep] else [docs.schema[text]])
    names = [f.name for f in keep]

    def run(batches):
        bpe = model(path)
        for whole in batches:
            for b in slices(whole, text):
                flat, ends = bpe.encode(b.column(b.schema.get_field_index(text)))
                got = [flat[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:])]
                cols = [b.column(b.schema.get_field_index(n)) for n in names] + [pa.array(got, pa.binary())]
                if decoded:
                    cols.append(pa.array([bpe.decode(x) for x in got], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names + [f.name for f in added])

    return docs.select([f.name for f in read]).mapInArrow(run, T.StructType(keep + added))


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``rows`` with the text that the binary ``ids`` decode to; null ids give ''."""
    keep = [f for f in rows.schema.fields if f.name != out]
    names = [f.name for f in keep]

    def run(batches):
        bpe = model(path)
        for b in batches:
            got = [bpe.decode(x or b"") for x in b.column(b.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(n)) for n in names] + [pa.array(got, pa.string())], names + [out])

    return rows.mapInArrow(run, T.StructType(keep + [T.StructField(out, T.StringType())]))


def n_ids(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
