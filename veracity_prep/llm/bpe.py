"""Exact byte-pair encoding by backtracking over longest token matches, and decoding by an offset table.

Encoding a word: an Aho-Corasick automaton over the vocabulary gives the longest token that starts at each
position. The encoder appends it if it is compatible with the token before it, else tries the next shorter
token that is a prefix of it, else marks the position dead and takes the last token back. Two neighbours are
compatible if byte-pair merging of their joined text gives just these two; that is read off the merge table by
undoing merges along the seam from the latest to the earliest, and remembered for each pair. Every position is
marked dead at most once, so the work is linear in the word.

Decoding gathers the tokens' bytes from one flat table by offset and length.

Null and empty texts have no tokens. The ids are those of the whole text; nothing is truncated or padded.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracity_prep.llm.shared import fresh, released

#: White space as the vocabulary's normalizer takes it; Python's own set also has U+001C to U+001F.
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
#: Beyond Latin letters and common punctuation, letter classes differ with the Unicode version: there the vocabulary's own
#: normalizer and splitter decide what the words are.
OTHER = re.compile("[^\0-\u024f\u2010-\u2027\u2030-\u2044\u20ac]")
END = "</w>"
#: Added to the code point of a word's last byte character: one symbol stands for it and the end of the word.
ENDED = 0x1000
#: Entries that a cache holds at most before it starts anew.
CACHED = 250_000


def byte_characters() -> list[str]:
    """The printable character for each byte: itself if it is printable Latin-1, else the next one from U+0100 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Tables of one vocabulary file (word-level BPE with word ends). Token numbers are merge ranks; ``ids`` has the file's."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        base = [c + e for e in ("", END) for c in byte_characters()]
        number = {t: i for i, t in enumerate(base)}
        self.head, self.tail, self.made = [-1] * len(base), [-1] * len(base), {}
        symbols = [c + "" for c in byte_characters()] + [chr(ord(c) + ENDED) for c in byte_characters()]
        for a, b in merges:
            i, j = number[a], number[b]
            number[a + b] = self.made[i, j] = len(symbols)
            self.head.append(i)
            self.tail.append(j)
            symbols.append(symbols[i] + symbols[j])
        self.base, self.symbols = len(base), symbols
        self.size = [len(s) for s in symbols]
        names = list(number)
        self.ids = np.array([vocab[t] for t in names], dtype="<u4")
        known = {s: i for i, s in enumerate(symbols)}
        self.shorter = [next((known[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in known), -1) for s in symbols]
        self.automaton = ahocorasick.Automaton()
        for i, s in enumerate(symbols):
            self.automaton.add_word(s, (i, len(s) - 1))
        self.automaton.make_automaton()
        self.to_symbols = str.maketrans({b: c for b, c in enumerate(byte_characters())})
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.special = {t["content"]: int(t["id"]) for t in spec["added_tokens"]}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        by_id = {int(i): t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        #: The offset table: bytes of every token with a blank after it, by id.
        texts = [(by_id.get(i, "") + " ").encode() for i in range(max(by_id) + 1)]
        self.lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(texts), dtype=np.uint8)

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the text of both keeps them apart."""
        made, head, tail, base = self.made, self.head, self.tail, self.base
        before = len(self.symbols)
        while True:
            # A merge across the seam that ranks before all merges undone so far would have come first.
            if made.get((left, right), before) < before:
                return False
            if left > right and left >= base:
                before, left = left, tail[left]
            elif right >= base:
                # Equal ranks go from left to right: across the seam comes first.
                before, right = right + 1, head[right]
            else:
                return True

    def word(self, word: str) -> bytes:
        """Ids of one word of the pre-tokenizer, as little-endian 32-bit integers."""
        return self.bytes_word(word.encode().decode("latin-1").translate(self.to_symbols))

    def bytes_word(self, text: str) -> bytes:
        """Ids of a word given as byte characters."""
        text = text[:-1] + chr(ord(text[-1]) + ENDED)
        longest = [0] * len(text)
        for end, (token, size) in self.automaton.iter(text):
            longest[end - size] = token  # ends come in order, so the longest stays
        size, pairs, shorter = self.size, self.pairs, self.shorter
        out: list[int] = []
        dead: set[int] = set()
        at, token, last = 0, longest[0], -1
        while at < len(text):
            while token >= 0:
                end = at + size[token]
                if end not in dead:
                    fits = True
                    if last >= 0 and (fits := pairs.get(last << 16 | token)) is None:
                        if len(pairs) > CACHED:
                            pairs.clear()
                        fits = pairs[last << 16 | token] = self.compatible(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, last = end, token
                token = longest[at] if at < len(text) else -1
            else:
                dead.add(at)
                token = out.pop()
                at -= size[token]
                last = out[-1] if out else -1
        return self.ids[out].tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Ids of a normalized text without white space."""
        if OTHER.search(chunk):
            return b"".join(self.bytes_word(piece) for piece, _ in self.split(chunk))
        found = []
        for piece in self.pieces(chunk):
            ids = self.words.get(piece)
            if ids is None:
                ids = self.word(piece)
                if len(piece) < 64:
                    if len(self.words) > CACHED:
                        self.words.clear()
                    self.words[piece] = ids
            found.append(ids)
        return b"".join(found)

    def plain(self, text: str) -> bytes:
        """Ids of a text that holds no special token."""
        if not text.isascii():
            text = self.normalize(text) if OTHER.search(text) else unicodedata.normalize("NFC", text)
        text = text.lower()
        chunks, out = self.chunks, []
        for chunk in SPACES.split(text) if SEPARATORS.search(text) else text.split():
            ids = chunks.get(chunk)
            if ids is None:
                ids = self.chunk(chunk)
                if len(chunk) < 64:
                    if len(chunks) > CACHED:
                        chunks.clear()
                    chunks[chunk] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text, as little-endian 32-bit integers."""
        if not text:
            return b""
        if self.at_special is None or not self.at_special.search(text):
            return self.plain(text)
        parts = self.at_special.split(text)
        return b"".join(np.uint32(self.special[p]).astype("<u4").tobytes() if p in self.special else self.plain(p) for p in parts if p)

    def decode(self, ids: bytes | None) -> str:
        """The tokens' texts with blanks between them, as a vocabulary without a decoder gives them."""
        return b"".join(self.decoded(ids)).decode()

    def decoded(self, ids: bytes | None) -> Iterator[bytes]:
        """The decoded text in pieces."""
        tokens = np.frombuffer(ids or b"", dtype="<u4")
        for k in range(0, len(tokens), 1 << 16):  # bounds the index arrays of very long texts
            part = tokens[k : k + (1 << 16)]
            length = self.lengths[part]
            ends = np.cumsum(length)
            piece = self.flat[np.repeat(self.offsets[part] - ends + length, length) + np.arange(ends[-1])]
            yield (piece if k + len(part) < len(tokens) else piece[:-1]).tobytes()


@functools.lru_cache(maxsize=2)
def tables(path: str) -> WordBpe:
    """The tables of a vocabulary file, once for each Python worker."""
    return WordBpe(path)


def encode(text: Column, path: str) -> Column:
    """Token ids of a text column as a binary column of little-endian unsigned 32-bit integers; null is empty."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tables(path)
        for batch in released(batches):
            yield pa.array((bpe.encode(t.as_py()) for t in batch), pa.binary(), size=len(batch))

    return run(text)


def decode(ids: Column, path: str) -> Column:
    """Text of a column that ``encode`` made, special tokens included; null is empty."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tables(path)
        for batch in batches:
            yield pa.array((bpe.decode(x.as_py()) for x in batch), pa.string(), size=len(batch))

    return run(ids)


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (binary) and ``n_tokens``; columns of these names that ``docs`` has are replaced.

    Rows are kept one for one, whatever their id; null and empty texts get no tokens.
    """
    return docs.withColumn("token_ids", encode(F.col(f"`{text}`"), path)).withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))


def decode_documents(encoded: DataFrame, path: str, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in ``to``."""
    return encoded.withColumn(to, decode(F.col(f"`{ids}`"), path))


def round_trip(docs: DataFrame, path: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """For each row of ``docs``: doc_id, n_tokens, and SHA-256 of the ids and of the text decoded from them.

    Ids and decoded texts stay in the Python worker and only their digests come back, unless ``keep_ids`` asks for
    ``token_ids`` (binary) as well.
    """
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("token_ids", pa.binary())] * keep_ids)

    @F.arrow_udf("struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string" + ",token_ids:binary" * keep_ids + ">")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = tables(path)

        def of(text: str | None) -> dict:
            ids = bpe.encode(text)
            decoded = hashlib.sha256()
            for part in bpe.decoded(ids):
                decoded.update(part)
            return {"n_tokens": len(ids) // 4, "ids_sha256": hashlib.sha256(ids).hexdigest(), "decoded_sha256": decoded.hexdigest(), "token_ids": ids}

        for batch in released(batches):
            yield pa.array((of(t.as_py()) for t in batch), kind, size=len(batch))

    digest = fresh(docs, "digest")
    return docs.select("doc_id", run(F.col(f"`{text}`")).alias(digest)).select("doc_id", f"{digest}.*")
