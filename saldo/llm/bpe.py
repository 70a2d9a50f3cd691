"""Byte-level BPE: exact encoding by backtracking over longest tokens, decoding by an offset table.

Two neighbouring tokens are compatible if merging their joined bytes gives these two tokens again.
A row of tokens that spells a text and whose neighbours are all compatible is the BPE encoding of
that text, and there is just one. The encoder therefore takes the longest token that an Aho-Corasick
automaton finds at the place, checks it against the token before it, and on failure tries the next
shorter one or steps back. A place from which no row of tokens led on is never tried again, so the
work is linear in the length of the text.
"""

from __future__ import annotations

import json
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import pre_tokenizers

from saldo.llm.common import held, map_columns

#: Fixed value: the pattern by which byte-level tokenizers cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Letters and numbers outside these long settled ranges depend on the Unicode version; texts with
#: other characters are cut by the library itself.
UNSETTLED = r"[^\x00-ԯḀ-ỿ -⁤₠-₿぀-ゖ゠-ヿ一-龥가-힣]"
#: Pieces remembered per Python worker before the memory is emptied, and compatible pairs.
REMEMBERED, REMEMBERED_PAIRS = 400_000, 400_000


class Splitter:
    """Cuts texts into the pieces of a byte-level tokenizer."""

    def __init__(self):
        self.find = regex.compile(PIECES).findall
        self.unsettled = regex.compile(UNSETTLED).search
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)

    def pieces(self, text: str) -> list[str]:
        if not text.isascii() and self.unsettled(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.find(text)


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of the bytes in vocabulary files, by their rule."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Bpe(dict):
    """Encoder and decoder of one vocabulary file; as a dict, piece -> its ids as int32 bytes."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        cut = data["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space")
        if model.get("type", "BPE") != "BPE" or data["normalizer"] or not plain:
            raise ValueError(f"{path} is no plain byte-level BPE")
        letters = byte_letters()
        # Bytes are held as strings of the characters 0 to 255: str is what the automaton takes.
        self.spelled = {
            i: "".join(chr(letters[c]) for c in token) for token, i in model["vocab"].items()
        }
        self.id_of = {s: i for i, s in self.spelled.items()}
        self.merge_of: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = model["vocab"][left], model["vocab"][right]
            self.merge_of.setdefault(pair, (rank, model["vocab"][left + right]))
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.at_special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
            if self.special else None
        )
        self.automaton = ahocorasick.Automaton()
        for token, i in self.id_of.items():
            if len(token) == 1 or self.reduce(token) == [i]:  # others are never made by merging
                self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.shorter_of: dict[int, int | None] = {}
        self.splitter = Splitter()
        # The offset table: token i is table[offsets[i]:offsets[i + 1]].
        known = {i: s.encode("latin-1") for i, s in self.spelled.items()}
        known |= {i: s.encode() for s, i in self.special.items()}
        spelled = [known.get(i, b"") for i in range(max(known) + 1)]
        self.offsets = np.array([0, *accumulate(map(len, spelled))], np.int64)
        self.table = np.frombuffer(b"".join(spelled), np.uint8)

    def reduce(self, spelled: str) -> list[int]:
        """Merges as defined: the pair of lowest rank first. For short strings only."""
        ids = [self.id_of[c] for c in spelled]
        while len(ids) > 1:
            best = min(
                ((self.merge_of[pair][0], at) for at, pair in enumerate(zip(ids, ids[1:])) if pair in self.merge_of),
                default=None,
            )
            if best is None:
                break
            at = best[1]
            ids[at : at + 2] = [self.merge_of[ids[at], ids[at + 1]][1]]
        return ids

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            known = self.reduce(self.spelled[left] + self.spelled[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self.shorter_of:
            spelled = self.spelled[token]
            self.shorter_of[token] = next(
                (self.automaton.get(spelled[:n]) for n in range(len(spelled) - 1, 0, -1) if spelled[:n] in self.automaton),
                None,
            )
        return self.shorter_of[token]

    def encode_piece(self, piece: str) -> list[int]:
        spelled = piece if piece.isascii() else piece.encode().decode("latin-1")
        whole = self.automaton.get(spelled, None)
        if whole is not None:
            return [whole]
        longest = self.automaton.iter_long
        ids = [i for _, i in longest(spelled)]
        if all(map(self.compatible, ids, ids[1:])):
            return ids
        size, ids, at = len(spelled), [], 0
        dead = bytearray(size + 1)
        token = next(longest(spelled, 0))[1]
        while True:
            end = at + len(self.spelled[token])
            if not dead[end] and (not ids or self.compatible(ids[-1], token)):
                ids.append(token)
                at = end
                if at == size:
                    return ids
                token = next(longest(spelled, at))[1]
                continue
            less = self.shorter(token)
            if less is None:
                dead[at] = 1
                less = ids.pop()
                at -= len(self.spelled[less])
            token = less

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        made = self[piece] = np.array(self.encode_piece(piece), np.int32).tobytes()
        return made

    def encode(self, text: str) -> bytes:
        """The ids of a text as int32 bytes; strings of added tokens become these tokens."""
        if self.at_special is None or not self.at_special.search(text):
            return b"".join(map(self.__getitem__, self.splitter.pieces(text)))
        out = []
        for part in self.at_special.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], np.int32).tobytes())
            else:
                out.extend(map(self.__getitem__, self.splitter.pieces(part)))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        starts, ends = self.offsets[ids], self.offsets[ids + 1]
        sizes = ends - starts
        before = np.cumsum(sizes) - sizes
        places = np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))
        return self.table[places].tobytes().decode("utf-8", errors="replace")


def loaded(path: str) -> Bpe:
    """One codec per Python worker and file; the file must lie at this path on every machine."""
    return held(f"codec {path}", lambda: Bpe(path))


def encode_array(codec: Bpe, texts: pa.Array) -> pa.ListArray:
    made = [codec.encode(t) if t else b"" for t in texts.to_pylist()]
    offsets = np.array([0, *accumulate(len(m) // 4 for m in made)], np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(made), np.int32)))


def decode_array(codec: Bpe, ids: pa.ListArray) -> pa.Array:
    offsets = ids.offsets.to_numpy()
    flat = ids.values.to_numpy(zero_copy_only=False)  # of a slice, offsets count from the whole
    texts = [codec.decode(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    return pa.array(texts, pa.string())


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with token_ids array<int>. A null or empty text has no ids."""
    return map_columns(
        docs, [text], lambda t: {"token_ids": encode_array(loaded(path), t)}, "token_ids array<int>"
    )


def decode(docs: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """docs with decoded, the text of the ids; null ids give an empty text.

    Ids outside the vocabulary are an error. Bytes that are no UTF-8 become U+FFFD.
    """

    def make(column: pa.Array) -> dict[str, pa.Array]:
        rows = pa.array([[] if x is None else x for x in column.to_pylist()], pa.list_(pa.int32()))
        return {"decoded": decode_array(loaded(path), rows)}

    return map_columns(docs, [ids], make, "decoded string")


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with token_ids and decoded in one pass: the text encoded, and the ids decoded again.

    Null and empty texts give no ids and an empty text. Very long texts and pieces take linear time.
    Rows are handled one by one, so order, ties and repeated rows do not matter; columns of docs
    named like a result are replaced by it.
    """

    def make(texts: pa.Array) -> dict[str, pa.Array]:
        codec = loaded(path)
        ids = encode_array(codec, texts)
        return {"token_ids": ids, "decoded": decode_array(codec, ids)}

    return map_columns(docs, [text], make, "token_ids array<int>, decoded string")
