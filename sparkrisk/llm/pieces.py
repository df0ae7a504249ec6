"""Encoding and decoding with a SentencePiece vocabulary of the merge type.

The merges of such a model join, again and again, the neighbours that form the best piece. The result is
the only sequence of pieces in which merging any two neighbours from their characters gives those two
back. It is found without merging whole words: an Aho-Corasick automaton gives the longest piece at each
place, a piece is taken if it agrees with the one before it, else a shorter one is tried, and if none
agrees the place is marked as failed and the piece before it is given back.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame

from sparkrisk.llm.common import map_texts

SPACE = "▁"
#: Encoded words and pairs of pieces that a Python process remembers before it starts anew.
WORD_MEMORY = 600_000
PAIR_MEMORY = 400_000
#: Longer words are encoded each time, so that what is remembered has a size.
WORD_LENGTH = 64
_PARTS = re.compile(r" *[^ \n]+| +|\n")
_PROBES = ("a", " a  b ", "\n\n x\ty", "Hello,  world!　① ﬁ", "     \n", "▁a <s> </s> <0x0A>")


@dataclass(frozen=True)
class Vocabulary:
    """The pieces that merging can make, with their scores, and the ids of the 256 byte pieces."""

    pieces: dict[str, tuple[int, float]]
    bytes_: tuple[int, ...]
    silent: frozenset[int]
    unknown: int


def load(path: str) -> Vocabulary:
    """Reads a model file; refuses models that are not merges over unchanged text with byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in plain}
    bytes_ = {int(model.id_to_piece(i)[3:5], 16): i for i in every if model.is_byte(i)}
    inner = [p for p in pieces if SPACE in p.lstrip(SPACE) or p.startswith(SPACE * 2) and p.strip(SPACE)]
    if len(bytes_) != 256 or inner or any(len(p) == 1 and p == "\n" for p in pieces):
        raise ValueError("pieces may have one space mark, at their start, and all bytes must have a piece")
    known = Vocabulary(pieces, tuple(bytes_[b] for b in range(256)), frozenset(i for i in every if model.is_control(i)), model.unk_id())
    own = Codec(known)
    for text in _PROBES:
        if own.encode(text) != model.encode(text):
            raise ValueError(f"the model does not merge unchanged text: {text!r}")
    return known


class Codec:
    """Encodes texts and decodes ids with a vocabulary; remembers words it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.pieces, self.bytes_, self.silent, self.unknown = (
            vocabulary.pieces, vocabulary.bytes_, vocabulary.silent, vocabulary.unknown)
        self.text = {i: p for p, (i, _) in self.pieces.items()}
        self.of_byte = {i: b for b, i in enumerate(self.bytes_)}
        self.shorter = {}
        self.automaton = ahocorasick.Automaton()
        for piece, (i, _) in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), i))
            self.shorter[i] = next((self.pieces[piece[:n]][0] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.pieces), None)
        self.automaton.make_automaton()
        self.length = {i: len(p) for i, p in self.text.items()}
        self.agreed: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.words: dict[str, tuple[int, str, bytes]] = {}
        self.runs: dict[int, list[int]] = {}

    def merge(self, text: str) -> list[int]:
        """The plain way: the best neighbours first, the leftmost of equals. Unknown characters give bytes."""
        parts: list[str | None] = list(text)
        before, after = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        waiting: list[tuple[float, int, str, int]] = []

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0 and (found := self.pieces.get(parts[a] + parts[b])):
                heapq.heappush(waiting, (-found[1], a, parts[a] + parts[b], b))

        for a in range(len(parts) - 1):
            offer(a, a + 1)
        while waiting:
            _, a, piece, b = heapq.heappop(waiting)
            if parts[a] is None or parts[b] is None or after[a] != b or parts[a] + parts[b] != piece:
                continue
            parts[a], parts[b] = piece, None
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [i for p in parts if p is not None for i in (
            (self.pieces[p][0],) if p in self.pieces else (self.bytes_[x] for x in p.encode("utf-8", "surrogatepass")))]

    def _agree(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.agreed.get(key)
        if known is None:
            if len(self.agreed) >= PAIR_MEMORY:
                self.agreed.clear()
            known = self.agreed[key] = self.merge(self.text[a] + self.text[b]) == [a, b]
        return known

    def _first(self, a: int) -> bool:
        known = self.whole.get(a)
        if known is None:
            known = self.whole[a] = self.merge(self.text[a]) == [a]
        return known

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text whose characters all have pieces; a space mark stands at its start only."""
        n = len(text)
        longest = [0] * n
        for end, (size, i) in self.automaton.iter(text):
            start = end - size + 1
            longest[start] = i  # longer ones end later
        failed = bytearray((n >> 3) + 1)  # a bit for each place from which the rest cannot be encoded
        taken: list[int] = []
        at, token = 0, longest[0] if n else None
        while at < n:
            end = at + self.length[token]
            if not failed[end >> 3] >> (end & 7) & 1 and (self._agree(taken[-1], token) if taken else self._first(token)):
                taken.append(token)
                at = end
                token = longest[at] if at < n else None
            elif (less := self.shorter[token]) is not None:
                token = less
            else:
                failed[at >> 3] |= 1 << (at & 7)
                token = taken.pop()
                at -= self.length[token]
        return taken

    def _chunk(self, text: str) -> list[int]:
        """Ids of a text without inner spaces; characters that no piece has become bytes."""
        known, ids, start = self.pieces, [], 0
        for k, c in enumerate(text):
            if c not in known:
                if start < k:
                    ids += self.backtrack(text[start:k])
                ids += [self.bytes_[x] for x in c.encode("utf-8", "surrogatepass")]
                start = k + 1
        return ids + self.backtrack(text[start:]) if start < len(text) else ids

    def word(self, word: str) -> tuple[int, str, bytes]:
        """Number of ids, ids joined by commas and the decoded bytes of a word after a space.

        A word that begins with a line break comes without a space before it.
        """
        found = self.words.get(word)
        if found is None:
            ids = self._chunk(word if word[:1] == "\n" else SPACE + word)
            found = len(ids), ",".join(map(str, ids)), self._bytes(ids)
            if len(word) <= WORD_LENGTH:
                if len(self.words) >= WORD_MEMORY:
                    self.words.clear()
                self.words[word] = found
        return found

    def _run(self, n: int) -> list[int]:
        """Ids of n spaces with nothing to join at their end."""
        if n not in self.runs:
            if len(self.runs) > 10_000:
                self.runs.clear()
            self.runs[n] = self.merge(SPACE * n)
        return self.runs[n]

    def _uneven(self, text: str) -> list[int]:
        """Ids of a text with runs of spaces: these merge last, so the word at their end takes its mark first."""
        mark, ids = self.pieces[SPACE][0], []
        for part in _PARTS.findall(text):
            word = part.lstrip(" ")
            n = len(part) - len(word)
            if not word:
                ids += self._run(n)
            elif n == 0:
                ids += self._chunk(word)
            else:
                own = self._chunk(SPACE + word)
                if n > 1:
                    own = self._run(n) + own[1:] if own[0] == mark else self._run(n - 1) + own
                ids += own
        return ids

    def encode_joined(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, ids joined by commas, and the text they decode to. Missing and empty texts have none."""
        if not text:
            return 0, "", ""
        text = text.replace(SPACE, " ")
        words = text.replace("\n", " \n").split(" ")
        if text[0] == "\n" or "" in words:
            ids = self._uneven(" " + text)
            return len(ids), ",".join(map(str, ids)), self.decode(ids)
        known = self.words
        try:
            found = [known[w] for w in words]
        except KeyError:
            found = [self.word(w) for w in words]
        return sum([x[0] for x in found]), ",".join([x[1] for x in found]), b"".join([x[2] for x in found])[1:].decode("utf-8", "surrogatepass")

    def encode(self, text: str | None) -> list[int]:
        joined = self.encode_joined(text)[1]
        return [int(x) for x in joined.split(",")] if joined else []

    def _bytes(self, ids: Sequence[int]) -> bytes:
        return b"".join([
            bytes([self.of_byte[i]]) if i in self.of_byte else self.text[i].replace(SPACE, " ").encode("utf-8", "surrogatepass")
            for i in ids])

    def decode(self, ids: Sequence[int]) -> str:
        """The text of the ids: the first space mark goes, a byte that is part of no character becomes U+FFFD."""
        out: list[str] = []
        raw = bytearray()

        def flush() -> None:
            at = 0
            while at < len(raw):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(raw[at:at + n]).decode("utf-8"))
                        at += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            raw.clear()

        first = True
        for i in ids:
            if i in self.of_byte:
                raw.append(self.of_byte[i])
                first = False
                continue
            flush()
            if i == self.unknown:
                out.append(" ⁇ ")
                first = False
            elif i not in self.silent:
                piece = self.text[i]
                out.append((piece[1:] if first and piece[0] == SPACE else piece).replace(SPACE, " "))
                first = False
        flush()
        return "".join(out)


_CODECS: dict[int, Codec] = {}


def _codec(vocabulary: Vocabulary) -> Codec:
    """One codec for each vocabulary and Python process, so that words stay known from task to task."""
    key = hash((len(vocabulary.pieces), vocabulary.bytes_, tuple(list(vocabulary.pieces.items())[:1000])))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary)
    return _CODECS[key]


def encode_table(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded of every row.

    The vocabulary (a fixed file, some hundred kilobytes) is read on the driver and broadcast. Missing and empty texts
    have no ids and decode to an empty text; repeated rows are encoded each; an empty table gives none.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(load(path))

    def work(texts: Iterable[str | None]):
        codec = _codec(vocabulary.value)
        for text in texts:
            ids = codec.encode(text)
            yield ids, codec.decode(ids)

    return map_texts(docs, "ids array<int>, decoded string", work, rows=100)


def digest_table(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; as ``encode_table``, without sending the ids."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(load(path))

    def work(texts: Iterable[str | None]):
        codec = _codec(vocabulary.value)
        for text in texts:
            n, ids, decoded = codec.encode_joined(text)
            yield n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()

    return map_texts(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string", work)
