"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The words of a batch that aren't known yet become one flat array of symbol ids, cut
into segments.  A round looks up the rank of every pair of neighbours, finds for each
segment the least (rank, place) and merges it; merged places are then compacted away.
Rounds go on until no pair of any segment is in the vocabulary.  Segments over
``near`` symbols merge every pair that is least among its neighbours within ``near``
places: a merge changes symbols of ``near`` / 2 characters at most, so such a pair is
merged before anything from outside can reach it, and the result is the same as
merging one pair at a time.

The vocabulary is only read (pieces, scores, kinds); no library encodes or decodes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import text_slices

SPACE = "▁"
#: Characters of encoded words (and 24 more a word) that a worker remembers before it starts anew.
REMEMBERED = 8_000_000
#: Longer words are forgotten once their rows are done: sentences of scripts without spaces don't come back.
LONG = 64
#: Bytes of text whose words are encoded together; a longer text is taken alone.
SLICE = 2 << 20


class Vocabulary:
    """Merge ranks and byte pieces of a BPE model with byte fallback and a dummy prefix."""

    def __init__(self, model: str | bytes):
        import sentencepiece

        kind = {"model_proto": model} if isinstance(model, bytes) else {"model_file": model}
        sp = sentencepiece.SentencePieceProcessor(**kind)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        odd = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in range(size)]
        self.bytes = {int(pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.of_byte = {i: b for b, i in self.bytes.items()}
        self.texts = [None if o else p.replace(SPACE, " ") for p, o in zip(pieces, odd, strict=True)]
        normal = {p: i for i, (p, o) in enumerate(zip(pieces, odd, strict=True)) if not o}
        # characters that are no piece, yet part of one, get symbols of their own
        parts = dict(normal)
        for p in normal:
            for c in p:
                parts.setdefault(c, len(pieces) + len(parts))
        names = sorted(parts, key=parts.get)
        self.symbol = {p: i for i, p in enumerate(names)}
        self.ids = np.array([normal.get(p, -1) for p in names])
        self.names = names
        # symbol of each code point; -1 - code point for those in no piece
        self.of_char = -1 - np.arange(0x110000)
        for p, i in self.symbol.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        self.is_byte = np.array([i in self.of_byte for i in range(size)])
        self.numbers = list(map(str, range(size)))
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in normal.values()}, reverse=True))}
        found = []
        for p, i in normal.items():
            for cut in range(1, len(p)):
                if p[:cut] in self.symbol and p[cut:] in self.symbol:
                    found.append((self.symbol[p[:cut]] * len(names) + self.symbol[p[cut:]], order[sp.get_score(i)], self.symbol[p]))
        found.sort()
        self.pairs, self.ranks, self.merged = (np.array(x, np.int64) for x in zip(*found, strict=True))
        self.near = 2 * max(map(len, normal))
        inner = {c for p in normal if len(p) > 1 for c in p}
        if any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("pieces that join words are not supported")
        # no merge crosses a cut between words, or touches a character that no longer piece has
        alone = "".join(re.escape(c) for c in ["\n", "\t", "\r"] if c not in inner)
        self.cut = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of all words after all merges, one word after the other, and each word's end; -1 - code point for characters in no piece."""
        sym = self.of_char[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        never = np.iinfo(np.int64).max
        at = self._pair(sym, word, np.arange(len(sym)))
        while len(sym):
            known = at >= 0
            live = np.zeros(len(words), bool)
            live[word[known]] = True
            stays = live[word]
            if not stays.all():  # words without pairs are finished
                done.append((sym[~stays], word[~stays]))
                at, known, sym, word = at[stays], known[stays], sym[stays], word[stays]
            n = len(sym)
            if not n:
                break
            # within a word the least rank wins, and of equal ranks the leftmost
            rank = np.where(known, self.ranks[at] * np.int64(1 << 40) + np.arange(n), never)
            heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            length = np.diff(np.append(heads, n))
            least = np.minimum.reduceat(rank, heads)
            chosen = least & np.int64((1 << 40) - 1)
            if (long := np.flatnonzero(length > self.near)).size:
                some = [chosen[length <= self.near]]
                for h, m in zip(heads[long], length[long], strict=True):
                    own = rank[h : h + m]
                    some.append(h + np.flatnonzero((own == _least_near(own, self.near)) & (own != never)))
                chosen = np.sort(np.concatenate(some))
            sym[chosen] = self.merged[at[chosen]]
            keep = np.ones(n, bool)
            keep[chosen + 1] = False
            # only pairs with a merged symbol are new
            new = np.zeros(n, bool)
            new[chosen] = True
            new[np.maximum(chosen - 1, 0)] = True
            before = chosen - 1
            gone = before[(before >= 0) & ~keep[np.maximum(before, 0)]]  # the neighbour before was merged away: its own left part is
            new[np.maximum(gone - 1, 0)] = True
            sym, word, at, new = sym[keep], word[keep], at[keep], np.flatnonzero(new[keep])
            at[new] = self._pair(sym, word, new)
        if done:
            sym, word = (np.concatenate([d[i] for d in done]) for i in (0, 1))
        order = np.argsort(word, kind="stable")
        return sym[order], np.cumsum(np.bincount(word, minlength=len(words)))

    def _pair(self, sym: np.ndarray, word: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The vocabulary's pair at each place and the one after it; -1 if there is none."""
        after = np.minimum(places + 1, len(sym) - 1)
        a, b = sym[places], sym[after]
        fits = (a >= 0) & (b >= 0) & (word[places] == word[after]) & (after > places)
        key = np.where(fits, a * len(self.names) + b, -1)
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, at, -1)

    def encode_flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and each word's end; characters in no piece become their UTF-8 bytes."""
        sym, ends = self.merge(words)
        ids = np.where(sym >= 0, self.ids[np.maximum(sym, 0)], -1)
        odd = np.flatnonzero(ids < 0)
        if not len(odd):
            return ids, ends
        raw = [self._bytes_of(int(s)) for s in sym[odd]]
        counts = np.ones(len(ids), np.int64)
        counts[odd] = list(map(len, raw))
        wide = np.repeat(ids, counts)
        wide[np.repeat(ids, counts) < 0] = [i for r in raw for i in r]
        return wide, np.append(0, np.cumsum(counts))[ends]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word."""
        ids, ends = self.encode_flat(words)
        flat, ends = ids.tolist(), ends.tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _bytes_of(self, s: int) -> list[int]:
        return [self.bytes[b] for b in (chr(-1 - s) if s < 0 else self.names[s]).encode()]

    def words(self, text: str) -> list[str]:
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.encode_words(self.words(text)) for i in ids]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: byte pieces as UTF-8 (U+FFFD for each byte that isn't), one leading space less."""
        out: list[str] = []
        run = bytearray()
        for i in [*ids, None]:
            if i in self.of_byte:
                run.append(self.of_byte[i])
                continue
            if run:
                out.append(_bytes_text(bytes(run)))
                run.clear()
            if i is not None:
                out.append(self.texts[i] or "")
        whole = "".join(out)
        return whole[1:] if ids and ids[0] not in self.of_byte and whole.startswith(" ") else whole


def _bytes_text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


def _least_near(x: np.ndarray, reach: int) -> np.ndarray:
    """For each place, the least value within ``reach`` places to either side."""
    big = np.iinfo(np.int64).max
    y = np.concatenate([np.full(reach, big), x, np.full(reach, big)])
    span, width = 2 * reach + 1, 1
    while width * 2 <= span:
        y = np.minimum(y[:-width], y[width:])
        width *= 2
    rest = span - width
    return np.minimum(y[: len(x)], y[rest : rest + len(x)])


@lru_cache(maxsize=2)
def vocabulary(model: str) -> Vocabulary:
    return Vocabulary(model)


class _Known(dict):
    """Encoded words: count of ids, ids as text, decoded text."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.size, self.long = vocab, 0, []

    def learn(self, words: set[str]) -> None:
        """Encode the words of some rows; long words of the rows before are forgotten, and all once they are too many."""
        for w in self.long:
            self.pop(w, None)
        if self.size > REMEMBERED:
            self.clear()
            self.size = 0
        new = [w for w in words if w not in self]
        self.long = [w for w in new if len(w) > LONG]
        self.size += sum(len(w) + 24 for w in new if len(w) <= LONG)
        vocab = self.vocab
        for lo in range(0, len(new), 20_000):
            part = new[lo : lo + 20_000]
            ids, ends = vocab.encode_flat(part)
            byte = np.append(0, np.cumsum(vocab.is_byte[ids]))[ends]  # bytes up to each word's end
            flat, ends = ids.tolist(), ends.tolist()
            numbers, texts = [vocab.numbers[i] for i in flat], [vocab.texts[i] for i in flat]
            a = 0
            for w, e, odd in zip(part, ends, np.diff(byte, prepend=0).tolist(), strict=True):
                # a word starts and ends with whole characters, so it decodes on its own
                text = vocab.decode([*self.vocab_space, *flat[a:e]]) if odd else "".join(texts[a:e])
                self[w] = (e - a, ",".join(numbers[a:e]), text)
                a = e

    @property
    def vocab_space(self) -> list[int]:
        # decode() drops one leading space: give it one to drop
        return [int(self.vocab.ids[self.vocab.symbol[SPACE]])]


def _digests(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        known = _Known(vocab)
        for batch in batches:
            for lo, _, offsets in text_slices(batch.column(1), SLICE):
                part = batch.slice(lo, len(offsets) - 1)
                split = [vocab.words(t or "") for t in part.column(1).to_pylist()]
                known.learn({w for words in split for w in words})
                n, ids, back = [], [], []
                for words in split:
                    found = [known[w] for w in words]
                    n.append(sum([f[0] for f in found]))
                    ids.append(hashlib.sha256(",".join([f[1] for f in found]).encode()).hexdigest())
                    text = "".join([f[2] for f in found])
                    back.append(hashlib.sha256((text[1:] if text.startswith(" ") else text).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def piece_digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, one row for each row of ``docs``; null text is empty and has no tokens.

    ``model`` is a path that every executor can read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_digests(model), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_texts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids: the ids of each text."""

    def run(batches):
        vocab = vocabulary(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([vocab.encode(t or "") for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_texts(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text of each array ``ids``; null ids give an empty text."""

    def run(batches):
        vocab = vocabulary(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([vocab.decode(x or []) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
