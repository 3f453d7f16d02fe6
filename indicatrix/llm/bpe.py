"""Byte-pair encoding and decoding with a vocabulary that ends words by a suffix, by depth-first walks over tries of words.

The encoding of a prefix of a piece is known from its last token alone: if that token has k symbols, the tokens before it are the encoding
of the prefix without its last k symbols. So each node of a trie of pieces needs one last token. A token may follow the last token
of the shorter prefix exactly if merging both by the rules leaves them as they are; of all tokens that end at a node, one
does. Distinct pieces are taken in order, which is a depth-first walk of their trie: a stack holds the last tokens of the current
path, and what two neighbours have in common is worked out once. The last symbol of a piece is a symbol of its own
(it carries the end of the word), a leaf beside the path.

Texts stay where they are: a task collects the distinct words of a chunk of whole texts, encodes those it has not met, and
puts numbers back by position. Nothing is shuffled. What a task remembers is bounded and forgotten whole; that changes no result.
Cutting words into pieces follows the file: special tokens as written, then normalised text, then its pattern.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicatrix.llm.words import bounds, buffers, chunks, word_column

REMEMBERED = 200_000
END = 256  # added to a byte that ends a piece
CHUNK_BYTES = 4 << 20
# Fixed value: the pattern of the file, and what it comes to where all letters are ASCII and in lower case.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_CUT = rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def file_text(path: str) -> str:
    """A tokenizer file as text, checked to be of the kind this module encodes. It is read by the driver; its size is fixed."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    data = json.loads(text)
    model, first = data["model"], data["added_tokens"]
    cuts = [p["type"] for p in (data["pre_tokenizer"] or {}).get("pretokenizers", [data["pre_tokenizer"] or {"type": ""}])]
    fits = (
        model["type"] == "BPE" and model["end_of_word_suffix"] and not model["continuing_subword_prefix"] and not model["ignore_merges"]
        and model["dropout"] is None and cuts[-1:] == ["ByteLevel"] and data["decoder"] is None
        and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in first)
    )
    if not fits:
        raise ValueError(f"not a vocabulary of byte pairs with word ends: {path}")
    return text


def byte_letters() -> list[str]:
    """The letter that stands for each byte in such files: printable Latin-1 for itself, others from 256 upwards."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = [""] * 256, 256
    for b in range(256):
        if b in own:
            letters[b] = chr(b)
        else:
            letters[b], extra = chr(extra), extra + 1
    return letters


class Vocabulary:
    """Tokens, merges and the pattern of a file, and the encodings met so far."""

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        data = json.loads(text)
        model = data["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.strings = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in data["added_tokens"]}
        self.base = {b: vocab[c] for b, c in enumerate(letters)} | {b + END: vocab[c + end] for b, c in enumerate(letters)}
        self.symbols = {i: (s,) for s, i in self.base.items()}
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        # How each token is formed: rank, left part, right part. Symbols are there from the start.
        self.formed: dict[int, tuple[int, int, int]] = dict.fromkeys(self.base.values(), (-1, -1, -1))
        in_order = True
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            token = vocab[a + b]
            self.rules[vocab[a], vocab[b]] = rank, token
            in_order &= token not in self.formed and vocab[a] in self.formed and vocab[b] in self.formed
            self.formed.setdefault(token, (rank, vocab[a], vocab[b]))
            self.symbols.setdefault(token, self.symbols[vocab[a]] + self.symbols[vocab[b]])
        # Each token comes from one rule, which follows those of its parts: then ranks are the times at which things merge.
        self.in_order = in_order
        self.lengths = {t: len(s) for t, s in self.symbols.items()}
        # Tokens by their symbols from the last to the first; None marks a token's own place.
        self.backwards: dict = {}
        for token, symbols in self.symbols.items():
            at = self.backwards
            for s in reversed(symbols):
                at = at.setdefault(s, {})
            at[None] = token
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # The rules that cut and fold text, without the vocabulary.
        bare = data | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}}
        self.library = Tokenizer.from_str(json.dumps(bare))
        self.stays: dict[int, bool] = {}
        self.words: dict[bytes, list[int]] = {}
        self.pieces: dict[bytes, list[int]] = {}
        cut = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] if len(data["pre_tokenizer"].get("pretokenizers", [])) == 2 else None
        lowers = [n["type"] for n in (data["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        # The same pattern and folding, where all letters are ASCII and no special token can be inside.
        self.ascii_cut = re.compile(ASCII_CUT).findall if cut == CUT and lowers and all("|" in s for s in self.special) else None

    def merged(self, symbols: tuple[int, ...]) -> list[int]:
        """Tokens of a few symbols by merging the pair of least rank, the first of equal ones."""
        tokens = [self.base[s] for s in symbols]
        while True:
            found = [(self.rules[p][0], i) for i in range(len(tokens) - 1) if (p := (tokens[i], tokens[i + 1])) in self.rules]
            if not found:
                return tokens
            i = min(found)[1]
            tokens[i : i + 2] = [self.rules[tokens[i], tokens[i + 1]][1]]

    def stay(self, first: int, second: int) -> bool:
        """Does merging the symbols of two tokens give these tokens? Of one, if the first is -1."""
        key = (first << 32) + second
        if key not in self.stays:
            if len(self.stays) > 4 * REMEMBERED:
                self.stays.clear()
            if first >= 0 and self.in_order and self.stay(-1, first) and self.stay(-1, second):
                self.stays[key] = not self.meet(first, second)
            else:
                tokens = [second] if first < 0 else [first, second]
                self.stays[key] = self.merged(sum((self.symbols[t] for t in tokens), ())) == tokens
        return self.stays[key]

    def meet(self, left: int, right: int) -> bool:
        """Do parts of two neighbouring tokens merge across their border before the tokens are whole?

        Backwards in time: what touches the border is first the tokens, then, of both, what the later formed one was made of. Two
        such parts merge if their rule comes before either goes into its own token; of equal rules the first place wins.
        """
        end_left = end_right = len(self.rules)
        while True:
            rank = self.rules.get((left, right), (end_left,))[0]
            if rank < end_left and rank <= end_right:
                return True
            rank_left, _, inner_left = self.formed[left]
            rank_right, inner_right, _ = self.formed[right]
            if rank_left < 0 and rank_right < 0:
                return False
            # Of equal ranks the left one was formed first.
            if rank_left > rank_right:
                left, end_left = inner_left, rank_left
            else:
                right, end_right = inner_right, rank_right

    def last_token(self, piece: bytes, depth: int, symbol: int, path: list[int]) -> int:
        """The last token of piece[:depth] followed by a symbol; path[k] is that of piece[:k], and path[0] is -1."""
        at, k, found, stays = self.backwards[symbol], depth, [], self.stays
        while True:
            if None in at:
                found.append((k, at[None]))
            k -= 1
            if k < 0 or (below := at.get(piece[k])) is None:
                break
            at = below
        for k, token in reversed(found):
            if known if (known := stays.get((path[k] << 32) + token)) is not None else self.stay(path[k], token):
                return token
        raise AssertionError("no token ends here")

    def encode_pieces(self, pieces: set[bytes]) -> dict[bytes, list[int]]:
        """Token ids of distinct pieces, in one depth-first walk."""
        out, path, before = {}, [-1], b""
        for piece in sorted(pieces):
            last = len(piece) - 1
            del path[min(common_length(before, piece), last) + 1 :]
            for depth in range(len(path) - 1, last):
                path.append(self.last_token(piece, depth, piece[depth], path))
            token = self.last_token(piece, last, piece[last] + END, path)
            tokens, at = [token], last + 1 - self.lengths[token]
            while at:
                token = path[at]
                tokens.append(token)
                at -= self.lengths[token]
            tokens.reverse()
            out[piece], before = tokens, piece[:last]
        return out

    def cut(self, word: bytes) -> list[bytes | int]:
        """Pieces of a word, which holds no ASCII white space, and ids of special tokens between them."""
        if self.ascii_cut and b"|" not in word and word.isascii():
            return self.ascii_cut(word.lower())
        text = word.decode("utf-8", "replace")
        parts = self.special_cut.split(text) if self.special_cut else [text]
        out: list[bytes | int] = []
        for at, part in enumerate(parts):
            if at % 2:
                out.append(self.special[part])
            elif part:
                folded = self.library.normalizer.normalize_str(part)
                # Places are counted in letters of the folded text.
                out += [folded[a:b].encode() for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(folded)]
        return out

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of distinct words."""
        cuts = {w: self.cut(w) for w in words if w not in self.words}
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        pieces = self.pieces
        pieces |= self.encode_pieces({p for cut in cuts.values() for p in cut if p.__class__ is bytes and p not in pieces})
        out = {}
        for word, cut in cuts.items():
            if len(cut) == 1 and cut[0].__class__ is bytes:
                out[word] = pieces[cut[0]]
            else:
                out[word] = [t for p in cut for t in (pieces[p] if p.__class__ is bytes else (p,))]
        found = [out[w] if w in out else self.words[w] for w in words]
        # What was met last is most likely to be met again.
        self.words = self.words | out if len(self.words) + len(out) <= REMEMBERED else out if len(out) <= REMEMBERED else {}
        return found

    def encoded(self, column) -> pa.ListArray:
        """Token ids of whole texts."""
        data, offsets = buffers(column)
        parts, sizes = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for first, last, part, places in chunks(data, offsets, CHUNK_BYTES):
            starts, ends, owner = bounds(part, places)
            words = word_column(part, starts, ends).dictionary_encode()
            distinct = self.encode(words.dictionary.cast(pa.binary()).to_pylist())
            codes = words.indices.to_numpy(zero_copy_only=False)
            flat = np.fromiter(chain.from_iterable(distinct), np.int32)
            lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))
            begins = np.cumsum(lengths) - lengths
            counts = lengths[codes]
            total = np.concatenate([[0], np.cumsum(counts)])
            parts.append(flat[np.arange(total[-1]) + np.repeat(begins[codes] - total[:-1], counts)])
            sizes.append(np.diff(total[np.searchsorted(owner, np.arange(last - first + 1))]))
        places = np.cumsum(np.concatenate(sizes))
        return pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(np.concatenate(parts)))

    def decoded(self, column) -> pa.Array:
        """Texts of lists of token ids; ids that the file does not have, and null ids, stand for nothing."""
        if not hasattr(self, "table"):
            self.table = pa.array([self.strings.get(i) for i in range(max(self.strings) + 1)])
        ids = column.flatten().to_numpy(zero_copy_only=False)
        known = np.isfinite(ids) & (ids >= 0) & (ids < len(self.table))
        known[known] &= self.table.take(pa.array(ids[known].astype(np.int64))).is_valid().to_numpy(zero_copy_only=False)
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        places = np.concatenate([[0], np.cumsum(known)])[np.concatenate([[0], np.cumsum(lengths)])]
        strings = self.table.take(pa.array(ids[known].astype(np.int64)))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(places, pa.int32()), strings), " ")


def common_length(a: bytes, b: bytes) -> int:
    """How many first bytes are equal."""
    n = 0
    for x, y in zip(a, b):
        if x != y or n == 64:
            break
        n += 1
    if n < 64:
        return n
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def per_batch(rows: DataFrame, path: str | None, method: str, name: str, kind: str) -> DataFrame:
    """First column, and a method of the vocabulary over the second. The file's text travels with the function."""
    text = file_text(path or default_path())

    def run(batches):
        vocabulary = Vocabulary(text)
        for batch in batches:
            yield pa.record_batch([batch.column(0), getattr(vocabulary, method)(batch.column(1))], ["doc_id", name])

    return rows.mapInArrow(run, f"doc_id long, {name} {kind}")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids, the token ids of the whole text, without special tokens around it.

    One row per row of ``docs``, repeated and null ids included; other columns are ignored. Null and empty texts, and those of
    white space alone, have no tokens. Bytes that are no UTF-8 count as replacement characters. ``path`` names the file.
    """
    return per_batch(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), path, "encoded", "ids", "array<int>")


def decode(encodings: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text, the strings of the token ids of each row with a blank between them, as such files decode.

    Special tokens are kept. Ids the file does not have and null ids are left out; null and empty lists give an empty text.
    """
    return per_batch(encodings.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")), path, "decoded", "text", "string")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids and text: what ``encode`` gives, and what ``decode`` makes of it, row by row."""
    text = file_text(path or default_path())

    def run(batches):
        vocabulary = Vocabulary(text)
        for batch in batches:
            ids = vocabulary.encoded(batch.column(1))
            yield pa.record_batch([batch.column(0), ids, vocabulary.decoded(ids)], ["doc_id", "ids", "text"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>, text string")


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Number of tokens and digests of ids and decoded text of every document."""
    return round_trip(docs, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
