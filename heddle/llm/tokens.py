"""Public tokenizers over many texts, each distinct piece encoded once per worker.

Blanks end a token in both kinds of vocabulary, so a text is cut there, and the
library encodes only pieces that this worker has not met.  The cache is bounded in bytes;
it only saves time.  A text with one of the library's own markers in it goes there whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of one generation of a worker's cache, which holds two, and what an entry takes beside its content.
CACHED = 104_000_000
ENTRY = 170

_PLAIN_WORD = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_PLAIN_CHUNK = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: Blanks in a row, other blanks and the mark below: such a text goes to the library whole.
_RARE = (
    r"  | \n|\n |\n\n|"
    r"[\x00\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
#: Marks a cut without a space in front.
_FIRST = "\x00"
_PROBES = ["the", " the", "straße", "façade", " Über", "zoology"]


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, and the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Cache:
    """Values by key in two generations, bounded in bytes: what is not asked for in a while goes."""

    def __init__(self, size: int):
        self.size, self.held, self.young, self.old = size, 0, {}, {}

    def turn(self) -> None:
        """Begin a new generation if this one is full; before a round of look-ups."""
        if self.held > self.size:
            self.old, self.young, self.held = self.young, {}, 0

    def missing(self, keys: set) -> list:
        """Those of ``keys``, none of them young, that must be made; the others are young from now on."""
        old, out = self.old, []
        for key in keys:
            value = old.get(key)
            if value is None:
                out.append(key)
            else:
                self.young[key] = value
        self.held += ENTRY * (len(keys) - len(out))
        return out


class PieceEncoder:
    """Ids of texts, as the library's ``encode`` without special tokens gives them."""

    def __init__(self, path: str, cached: int = CACHED):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.known = Cache(cached)
        # a text that holds one of the library's own markers is encoded whole
        self.markers = [t.content.lower() for t in self.library.get_added_tokens_decoder().values()]
        self.marked = commonprefix(self.markers)
        self.drops_blanks = self.library.encode("a b", add_special_tokens=False).ids == self.library.encode(
            "a\n b", add_special_tokens=False
        ).ids
        self.folds_case = self.library.encode("A", add_special_tokens=False).ids == self.library.encode(
            "a", add_special_tokens=False
        ).ids
        if self.drops_blanks and self.folds_case:
            self.plain = _PLAIN_WORD.fullmatch
        else:
            self.plain = (lambda _: None) if self.drops_blanks else _PLAIN_CHUNK.fullmatch

        # a piece of letters needs no normalisation: the model alone gives its ids
        self.letters = _byte_letters()
        self.packed = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        probes = _PROBES[:1] + _PROBES[2:4] if self.drops_blanks else _PROBES
        try:
            self.direct = [self._by_model(p) for p in probes] == self._whole(probes)
        except Exception:  # noqa: BLE001  a model of another kind
            self.direct = False

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_model(self, piece: str) -> bytes:
        if piece.isascii():  # letters stand for themselves
            spelled = self.letters[32] + piece[1:] if piece[0] == " " else piece
        else:
            spelled = "".join([self.letters[b] for b in piece.encode()])
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(spelled)])

    def _text(self, key) -> str:
        """The characters that a cut stands for."""
        if self.drops_blanks:
            return str(key, "utf-8", "surrogatepass")
        return key[1:] if key[:1] == _FIRST else " " + key

    def _make(self, new: list) -> None:
        """Keep the ids of cuts that this worker has not met.

        Letters go to the model, marks behind them are a cut of their own, and the library
        encodes the rest.
        """
        young, plain, text_of, by_model = self.known.young, self.plain, self._text, self._by_model
        rest, behind, lines = {}, [], []
        for key in new:
            if key[:1] == "\n":
                lines.append(key)
                continue
            text = text_of(key)
            letters = plain(text) if self.direct else None
            if letters is None:
                rest[key] = text
            elif letters.end(1) == len(text):
                young[key] = by_model(text)
            else:  # marks are ASCII, so both kinds of cuts end in them
                n = len(text) - letters.end(1)
                word, marks = key[:-n], key[-n:] if self.drops_blanks else _FIRST + key[-n:]
                if word not in young:
                    young[word] = by_model(text[:-n])
                if marks not in young:
                    rest[marks] = text[-n:]
                behind.append((key, word, marks))
        if lines:  # a line end stands alone, and no space is behind it
            rest["\n"] = "\n"
            self._make([_FIRST + key[1:] for key in lines if len(key) > 1])
        if rest:
            young.update(zip(rest, self._whole(list(rest.values()))))
        for key, word, marks in behind:
            young[key] = young[word] + young[marks]
        for key in lines:
            young[key] = young["\n"] + (young[_FIRST + key[1:]] if len(key) > 1 else b"")
        self.known.held += len(new) * (ENTRY + 8) + sum(map(len, new))

    def _whole_ones(self, texts: pa.Array) -> np.ndarray:
        """Which texts go to the library whole."""
        flags = lambda found: found.to_numpy(zero_copy_only=False).astype(bool)
        whole = np.zeros(len(texts), bool)
        for i in np.flatnonzero(flags(pc.match_substring(texts, self.marked))).tolist() if self.markers else []:
            low = texts[i].as_py().lower()
            whole[i] = any(m in low for m in self.markers)
        return whole if self.drops_blanks else whole | flags(pc.match_substring_regex(texts, _RARE))

    def _cuts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Cuts whose ids, one after another, are those of the texts; their number per text, and which ones are nothing."""
        if self.drops_blanks:
            low = pc.ascii_lower(texts) if self.folds_case else texts
            lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(low))
            flat = lists.flatten()
            nothing = np.flatnonzero(pc.binary_length(flat).to_numpy() == 0)
        else:
            # a cut stands for itself with the space in front, but for the first and line ends
            apart = pc.replace_substring(texts, "\n", " \n")
            bare = pc.or_(pc.starts_with(apart, " "), pc.equal(apart, ""))
            mark = pc.if_else(bare, pa.scalar("", apart.type), pa.scalar(_FIRST, apart.type))
            lists = pc.split_pattern(pc.binary_join_element_wise(mark, apart, pa.scalar("", apart.type)), " ")
            flat, nothing = lists.flatten(), None
        n = pc.list_value_length(lists).to_numpy().astype(np.int64)
        if nothing is None:
            nothing = (np.cumsum(n) - n)[bare.to_numpy(zero_copy_only=False).astype(bool)]
        return flat, n, nothing

    def encode(self, texts: pa.Array | Iterable[str | None]) -> list[np.ndarray]:
        """One array of 32-bit ids per text; a NULL text is empty.

        Arrow cuts a column of texts and numbers its distinct cuts; only those are looked up.
        """
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        texts = pc.fill_null(texts, "")
        whole = self._whole_ones(texts)
        flat, n, nothing = self._cuts(pc.if_else(pa.array(~whole), texts, pa.scalar("", texts.type)))
        coded = flat.dictionary_encode()
        values = coded.dictionary
        words = (values.cast(pa.large_binary()) if self.drops_blanks else values).to_numpy(zero_copy_only=False).tolist()
        self.known.turn()
        young = self.known.young
        found = list(map(young.get, words))
        gaps = [(at, words[at]) for at, known in enumerate(found) if known is None and words[at] != b""]
        if gaps:
            self._make(self.known.missing({w for _, w in gaps}))
            for at, w in gaps:
                found[at] = young[w]
        found = [ids or b"" for ids in found]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        code = coded.indices.to_numpy()
        length = sizes[code]
        length[nothing] = 0
        ends = np.cumsum(length)
        from_ = (np.cumsum(sizes) - sizes)[code] - (ends - length)
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(from_, length) + np.arange(len(code) and ends[-1])]
        bounds = np.append(0, ends)[np.cumsum(n)]
        out = np.split(ids, bounds[:-1]) if len(bounds) else []
        places = np.flatnonzero(whole).tolist()
        for i, packed in zip(places, self._whole([texts[i].as_py() for i in places]) if places else []):
            out[i] = np.frombuffer(packed, "<u4")
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a tokenizer file."""
    import os

    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def slices(texts: pa.Array, size: int = 4_000_000) -> Iterator[tuple[int, pa.Array]]:
    """Runs of the texts of a batch that hold about ``size`` bytes together, each with its first place."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first, n = 0, len(ends)
    while first < n:
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, "right")))
        yield first, texts.slice(first, last - first)
        first = last


def sub_batches(texts: pa.Array, size: int = 4_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """The same as lists."""
    for first, some in slices(texts, size):
        yield first, some.to_pylist()
