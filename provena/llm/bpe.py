"""BPE encoding and decoding: speculate, verify, repair.

A word's encoding is proposed by greedy longest match over the vocabulary.  The proposal is the true encoding exactly
when each token encodes to itself and every two neighbours are compatible, i.e. encoding their joined text gives the
two tokens back.  Neighbours are tested all at once: the two tokens are taken apart along their inner edge, merge by
merge in order of rank, and a pair is refused when a merge across the edge would have come first.  Only the words of
which a pair fails go through exact merging (lowest rank first), also vectorised.

The tokenizer file gives vocabulary and merges; its normaliser (NFC, lower case), word pattern and byte alphabet are
the ones of the word-end BPE this module reads.  Special tokens standing in a text keep their ids.  The file's tables
travel to the tasks as one broadcast of the file's bytes, whose size is checked.

Defined results: null text encodes as the empty text; an empty text has no ids and decodes to ''; repeated rows are
encoded each by itself; any text length is taken whole.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import CACHES, Lookup, add_columns, buffer_of, byte_hashes, claim, same_bytes, ship, slices

#: Fixed value: the word pattern of the tokenizer file (contractions, letters, one digit, other marks).
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"
MAX_FILE_BYTES = 64 << 20
#: pieces in each of the memo's two generations
MEMO_WORDS = 250_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    chars = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in chars:
            chars[b] = chr(256 + len(chars) - len(plain))
    return [chars[b] for b in range(256)]


class Memo:
    """Ids of pieces.  Pieces are known by a hash, in a table with open addressing, and told apart by their bytes; their
    bytes and ids stand in one row each.  A piece is named by its number."""

    def __init__(self):
        self.n, self.raw_used, self.ids_used = 0, 0, 0
        self.slots = np.zeros(1 << 16, np.int32)  # number + 1; 0: free
        self.raw, self.ids = np.zeros(1 << 18, np.uint8), np.zeros(1 << 16, np.uint32)
        self.hash = np.zeros(1 << 14, np.uint64)
        self.raw_at, self.raw_size, self.ids_at, self.ids_size = (np.zeros(1 << 14, np.int64) for _ in range(4))

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - (len(self.slots).bit_length() - 1))).astype(np.int64)

    def find(self, h: np.ndarray, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The number of each piece (its hash, bytes and their offsets), or -1."""
        out = np.full(len(h), -1, np.int64)
        live, at = np.arange(len(h)), self._slot(h)
        size = np.diff(off)
        while len(live):
            seen = self.slots[at].astype(np.int64) - 1
            there = seen >= 0
            live, at, seen = live[there], at[there], seen[there]
            hit = np.flatnonzero((self.hash[seen] == h[live]) & (self.raw_size[seen] == size[live]))
            same = hit[same_bytes(raw, off[live[hit]], self.raw, self.raw_at[seen[hit]], size[live[hit]])]
            out[live[same]] = seen[same]
            go = np.ones(len(live), bool)
            go[same] = False
            live, at = live[go], (at[go] + 1) & (len(self.slots) - 1)
        return out

    def add(self, h: np.ndarray, raw: np.ndarray, off: np.ndarray, which: np.ndarray, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Keep new pieces (those of ``which``) with their ids, one after the other; returns their numbers."""
        m, size = len(which), np.diff(off)[which]
        number = np.arange(self.n, self.n + m)
        for name in ("hash", "raw_at", "raw_size", "ids_at", "ids_size"):
            setattr(self, name, _room(getattr(self, name), self.n + m))
        self.raw, self.ids = _room(self.raw, self.raw_used + int(size.sum())), _room(self.ids, self.ids_used + len(ids))
        self.hash[number], self.raw_size[number], self.ids_size[number] = h[which], size, count
        self.raw_at[number] = self.raw_used + np.cumsum(size) - size
        self.ids_at[number] = self.ids_used + np.cumsum(count) - count
        self.raw[self.raw_used:self.raw_used + int(size.sum())] = raw[_runs(off[:-1][which], size)]
        self.ids[self.ids_used:self.ids_used + len(ids)] = ids
        self.n, self.raw_used, self.ids_used = self.n + m, self.raw_used + int(size.sum()), self.ids_used + len(ids)
        if 2 * self.n > len(self.slots):
            self.slots = np.zeros(1 << int(4 * self.n - 1).bit_length(), np.int32)
            self._place(np.arange(self.n))
        else:
            self._place(number)
        return number

    def _place(self, number: np.ndarray) -> None:
        at = self._slot(self.hash[number])
        while len(number):
            free = self.slots[at] == 0
            self.slots[at[free]] = number[free] + 1  # of several for one slot the last stays, the others go on
            left = self.slots[at] != number + 1
            number, at = number[left], (at[left] + 1) & (len(self.slots) - 1)

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces with these numbers, one after the other, and how many each has."""
        count = self.ids_size[which]
        return self.ids[_runs(self.ids_at[which], count)], count


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for ``size`` places each, one after the other."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _room(a: np.ndarray, n: int) -> np.ndarray:
    """The array, or a larger copy that holds n values."""
    if n <= len(a):
        return a
    out = np.zeros(max(n, 2 * len(a)), a.dtype)
    out[:len(a)] = a
    return out


class ChunkEncoder:
    """Encodes texts by their pieces between white space, each distinct piece once while the memo holds it.  The memo has
    two generations: when the young one is full it becomes the old one, and a piece found in the old one is young again,
    so what is in use stays.  White space never takes part in a token, and special tokens are cut out of the raw text
    first, so a text's ids are its pieces' ids in order.  Splitting and telling pieces apart is Arrow's work, putting ids
    together numpy's; Python sees the pieces only that are new."""

    def __init__(self, special: dict[str, int]):
        self.special = special
        cut = "|".join(regex.escape(s) for s in special)
        self.split = regex.compile(f"({cut})") if special else None
        #: texts that Arrow must not split: a special token, or a character that it takes for white space and the tokenizer doesn't
        self.odd = "[\x1c-\x1f]" + (f"|{cut}" if special else "")
        self.gap = regex.compile(r"\p{White_Space}+")
        self.memo, self.old = Memo(), Memo()

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, one after the other, and how many each has."""
        raise NotImplementedError

    def _chunks(self, text: str) -> list[str]:
        row: list[str] = []
        for k, piece in enumerate(self.split.split(text) if self.split is not None else [text]):
            if k % 2:
                row.append("\n" + piece)  # a special token; no piece holds a line end
            else:
                row.extend(c for c in self.gap.split(piece) if c)
        return row

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The memo's numbers of distinct pieces; what it does not hold is encoded."""
        if self.memo.n > MEMO_WORDS:
            self.memo, self.old = Memo(), self.memo
        raw, off = buffer_of(pieces)
        h = byte_hashes(raw, off)
        out = self.memo.find(h, raw, off)
        new = np.flatnonzero(out < 0)
        if len(new):
            size = np.diff(off)[new]
            body, ends = raw[_runs(off[:-1][new], size)], np.r_[0, np.cumsum(size)]
            was = self.old.find(h[new], body, ends)
            again, fresh = np.flatnonzero(was >= 0), np.flatnonzero(was < 0)
            out[new[again]] = self.memo.add(h, raw, off, new[again], *self.old.gather(was[again]))
            if len(fresh):
                words = pieces.take(pa.array(new[fresh])).to_pylist()
                special = np.array([w[:1] == "\n" for w in words])
                for part, encode in ((~special, self._encode_chunks), (special, self._encode_special)):
                    if part.any():
                        named = [w for w, p in zip(words, part.tolist()) if p]
                        out[new[fresh[part]]] = self.memo.add(h, raw, off, new[fresh[part]], *encode(named))
        return out

    def _encode_special(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.array([self.special[p[1:]] for p in pieces], np.uint32), np.ones(len(pieces), np.int64)

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (a large_string array without nulls), one after the other, and how many each has."""
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        rows = [self._chunks(t) for t in texts.filter(pa.array(odd)).to_pylist()] if odd.any() else []
        lists = pc.utf8_split_whitespace(texts.filter(pa.array(~odd)) if rows else texts)
        flat = lists.flatten()
        if rows:
            flat = pa.concat_arrays([flat, pa.array([p for row in rows for p in row], pa.large_string())])
        coded = flat.dictionary_encode()  # an empty piece (white space at an end) encodes to nothing
        codes = coded.indices.to_numpy()
        per = np.zeros(len(texts), np.int64)
        per[~odd] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        if rows:
            per[odd] = [len(row) for row in rows]
            place, from_odd = np.empty(len(codes), np.int64), np.repeat(odd, per)
            place[~from_odd] = np.arange(len(codes) - int(from_odd.sum()))
            place[from_odd] = np.arange(len(codes) - int(from_odd.sum()), len(codes))
            codes = codes[place]
        numbers = self._numbers(coded.dictionary)
        ids, count = self.memo.gather(numbers[codes])
        run, ends = np.r_[0, np.cumsum(count)], np.cumsum(per)
        return ids, run[ends] - run[ends - per]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, count = self.encode_array(pa.array(texts, pa.large_string()))
        data, ends = ids.astype("<u4").tobytes(), (np.cumsum(count) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]


class WordBpe(ChunkEncoder):
    """Encoder over one tokenizer file.  Symbols 0-255: a byte; 256-511: a word's last byte."""

    def __init__(self, spec: bytes):
        d = json.loads(spec)
        model = d["model"]
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        alphabet = byte_alphabet()
        super().__init__({t["content"]: t["id"] for t in d["added_tokens"]})
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.texts = [""] * size
        for s, i in [*vocab.items(), *self.special.items()]:
            self.texts[i] = s
        self.token_texts = pa.array(self.texts, pa.string())
        self.base = np.array([vocab[alphabet[b]] for b in range(256)] + [vocab[alphabet[b] + self.end] for b in range(256)], np.int64)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        #: rank of the merge that makes a token; -1 for the symbols
        self.rank = np.full(size, -1, np.int64)
        self.rank[made[::-1]] = np.arange(len(made))[::-1]
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.left[made[::-1]], self.right[made[::-1]] = left[::-1], right[::-1]
        self.size = size
        self.made = made
        self.pairs = Lookup((left * size + right).astype(np.uint64))
        back = {c: b for b, c in enumerate(alphabet)}
        self._grow_trie([(self._symbols(s, back), i) for s, i in vocab.items()])
        self.sound = self._self_encoding(vocab, back)
        self.verdicts = np.zeros(1 << 18, np.uint64)  # direct-mapped: pair + 1, verdict in the lowest bit
        #: the tokenizer's words, and the line ends that this module puts between two pieces
        self.word = regex.compile(r"\n|" + WORD)
        self.stats = {"words": 0, "repaired": 0}

    def _symbols(self, s: str, back: dict[str, int]) -> list[int]:
        if s.endswith(self.end) and len(s) > len(self.end):
            x = [back[c] for c in s[:-len(self.end)]]
            x[-1] += 256
            return x
        return [back[c] for c in s]

    def _grow_trie(self, tokens: list[tuple[list[int], int]]) -> None:
        step: dict[int, int] = {}
        token = [-1]
        for symbols, i in tokens:
            node = 0
            for x in symbols:
                key = node * 512 + x
                node = step.get(key, -1)
                if node < 0:
                    node = step[key] = len(token)
                    token.append(-1)
            token[node] = i
        self.step = Lookup(np.fromiter(step.keys(), np.uint64, len(step)))
        self.child = np.fromiter(step.values(), np.int64, len(step))
        self.token_at = np.array(token, np.int64)
        first = np.zeros(512, np.int64)
        for x in range(512):
            first[x] = step.get(x, 0)
        self.first = first

    def _self_encoding(self, vocab: dict[str, int], back: dict[str, int]) -> np.ndarray:
        """Which tokens come out of encoding their own text.  A token without word end is read as a word's inside."""
        ids = list(vocab.values())
        flat, off = self._flat([self._symbols(s, back) for s in vocab])
        got, count = self._merge(self.base[flat], off)
        ok = np.zeros(self.size, bool)
        at = np.cumsum(count) - count
        for k, i in enumerate(ids):
            ok[i] = count[k] == 1 and got[at[k]] == i
        return ok

    @staticmethod
    def _flat(parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        off = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=off[1:])
        return np.fromiter((x for p in parts for x in p), np.int64, int(off[-1])), off

    # -- speculate ------------------------------------------------------------------------------------------
    def _greedy(self, symbols: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest match from left to right for all words at once: the tokens, and the word of each, in order."""
        word = np.arange(len(off) - 1)
        pos, stop = off[:-1].copy(), off[1:]
        out_word, out_pos, out_token = [], [], []
        begin = pos.copy()
        while len(word):
            # one token for every live word: walk the trie as far as it goes, keep the last token seen
            best = self.base[symbols[begin]]
            best_end = begin + 1
            node = self.first[symbols[begin]]
            live = np.flatnonzero((node > 0) & (begin + 1 < stop[word]))
            at = begin[live] + 1
            node = node[live]
            end = stop[word[live]]
            while len(live):
                hit = self.step.find((node * 512 + symbols[at]).astype(np.uint64))
                go = hit >= 0
                live, at, end = live[go], at[go] + 1, end[go]
                node = self.child[hit[go]]
                t = self.token_at[node]
                seen = t >= 0
                best[live[seen]] = t[seen]
                best_end[live[seen]] = at[seen]
                more = at < end
                live, at, end, node = live[more], at[more], end[more], node[more]
            out_word.append(word)
            out_pos.append(begin)
            out_token.append(best)
            go = best_end < stop[word]
            word, begin = word[go], best_end[go]
        w, p, t = np.concatenate(out_word), np.concatenate(out_pos), np.concatenate(out_token)
        order = np.argsort(p, kind="stable")
        return t[order], w[order]

    # -- verify ---------------------------------------------------------------------------------------------
    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For every pair: does encoding the joined text of a and b give [a, b]?"""
        key = (a * self.size + b).astype(np.uint64)
        slot = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)
        kept = self.verdicts[slot]
        known = (kept >> np.uint64(1)) == key + np.uint64(1)
        out = (kept & np.uint64(1)).astype(bool)
        todo = np.flatnonzero(~known)
        if len(todo):
            unique, back = np.unique(key[todo], return_inverse=True)
            fresh = self._test_pairs((unique // np.uint64(self.size)).astype(np.int64), (unique % np.uint64(self.size)).astype(np.int64))
            out[todo] = fresh[back]
            self.verdicts[slot[todo]] = ((key[todo] + np.uint64(1)) << np.uint64(1)) | out[todo].astype(np.uint64)
        return out

    def _test_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo the merges of a and b that touch their common edge, latest first.  In the true run the tokens x | y at
        the edge stand side by side until the earlier of their own next merges, so a merge x+y of lower rank (or of
        equal rank, where the left one goes first) would have crossed the edge."""
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a.copy(), b.copy()
        # the merge that consumes x (on the left) or y (on the right) next; none yet
        none = len(self.made)
        gone_x, gone_y = np.full(len(a), none), np.full(len(a), none)
        while len(live):
            hit = self.pairs.find((x * self.size + y).astype(np.uint64))
            # merges at one rank run from left to right: x's own consumer starts left of the edge and goes first at a
            # tie, y's consumer starts right of it and goes later
            cross = (hit >= 0) & (hit < gone_x) & (hit <= gone_y)
            ok[live[cross]] = False
            rx, ry = self.rank[x], self.rank[y]
            on = ~cross & ((rx >= 0) | (ry >= 0))
            live, x, y, rx, ry, gone_x, gone_y = live[on], x[on], y[on], rx[on], ry[on], gone_x[on], gone_y[on]
            take_x = rx > ry
            # equal ranks: the same merge on either side; the right one ran later, so it is undone first
            gone_x = np.where(take_x, rx, gone_x)
            gone_y = np.where(take_x, gone_y, ry)
            x, y = np.where(take_x, self.right[x], x), np.where(take_x, y, self.left[y])
        return ok

    # -- repair ---------------------------------------------------------------------------------------------
    def _merge(self, tokens: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of every word: one merge a round, the lowest rank first, the leftmost of equals."""
        n = len(off) - 1
        tokens = tokens.copy()
        word = np.repeat(np.arange(n), np.diff(off))
        done_t, done_w = [], []
        none = len(self.made)
        while len(tokens):
            pair = np.full(len(tokens), none, np.int64)
            same = np.flatnonzero(word[:-1] == word[1:])
            hit = self.pairs.find((tokens[same] * self.size + tokens[same + 1]).astype(np.uint64))
            pair[same] = np.where(hit >= 0, hit, none)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(pair * (len(tokens) + 1) + np.arange(len(tokens)), first)
            size = np.diff(np.r_[first, len(tokens)])
            alive = low < none * (len(tokens) + 1)
            stay = np.repeat(alive, size)
            done_t.append(tokens[~stay])
            done_w.append(word[~stay])
            at = low[alive] % (len(tokens) + 1)
            tokens[at] = self.made[pair[at]]
            stay[at + 1] = False
            tokens, word = tokens[stay], word[stay]
        t, w = (np.concatenate(done_t), np.concatenate(done_w)) if done_t else (tokens, word)
        order = np.argsort(w, kind="stable")
        return t[order], np.bincount(w, minlength=n)

    def _encode_flat(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty words (their bytes, one after the other, and their sizes) and the number of each."""
        if not len(size):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        off = np.r_[0, np.cumsum(size)]
        symbols = raw.astype(np.int64)
        symbols[off[1:] - 1] += 256
        token, word = self._greedy(symbols, off)
        count = np.bincount(word, minlength=len(size))
        bad = np.zeros(len(size), bool)
        bad[word[~self.sound[token]]] = True
        inner = np.flatnonzero(word[:-1] == word[1:])
        fails = ~self.compatible(token[inner], token[inner + 1])
        bad[word[inner[fails]]] = True
        self.stats["words"] += len(size)
        if bad.any():
            which = np.flatnonzero(bad)
            self.stats["repaired"] += len(which)
            part = np.repeat(bad, size)
            fixed, fixed_count = self._merge(self.base[symbols[part]], np.r_[0, np.cumsum(size[which])])
            good = ~bad[word]
            token = np.concatenate([token[good], fixed])
            word = np.concatenate([word[good], np.repeat(which, fixed_count)])
            token = token[np.argsort(word, kind="stable")]
            count[which] = fixed_count
        return token, count

    # -- texts ----------------------------------------------------------------------------------------------
    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces without white space: normalised and cut into words all at once, a line end between two."""
        text = "\n".join(chunks)
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        found = self.word.findall(text.lower())
        utf8 = "\0".join(found).encode()
        if utf8.count(b"\0") == len(found) - 1:  # no word holds the byte 0: sizes without a loop
            cut = np.flatnonzero(np.frombuffer(utf8, np.uint8) == 0)
            size = np.diff(np.r_[-1, cut, len(utf8)]) - 1
            raw = np.delete(np.frombuffer(utf8, np.uint8), cut)
        else:
            words = [w.encode() for w in found]
            size = np.fromiter(map(len, words), np.int64, len(words))
            raw = np.frombuffer(b"".join(words), np.uint8)
        off = np.r_[0, np.cumsum(size)]
        mark = (size == 1) & (raw[off[:-1]] == 10)  # the line ends between chunks
        keep = ~np.repeat(mark, size)
        ids, count = self._encode_flat(raw[keep], size[~mark])
        owner = np.cumsum(mark)[~mark]
        return ids.astype(np.uint32), np.bincount(owner, weights=count, minlength=len(chunks)).astype(np.int64)

    def decode(self, ids: bytes) -> bytes:
        """The tokens' texts with a space between two, special tokens included, in UTF-8."""
        ids = np.frombuffer(ids, "<u4")
        return decoded_texts(self.token_texts, ids, np.array([len(ids)]))[0].as_py().encode()


def token_texts(spec: bytes) -> pa.Array:
    """The text of every token id; all that decoding needs."""
    d = json.loads(spec)
    pairs = [*d["model"]["vocab"].items(), *((t["content"], t["id"]) for t in d["added_tokens"])]
    out = [""] * (max(i for _, i in pairs) + 1)
    for s, i in pairs:
        out[i] = s
    return pa.array(out, pa.string())


_READY: dict[str, WordBpe] = {}
CACHES.append(_READY)


def encoder_of(key: str, spec) -> WordBpe:
    """One encoder per worker process and tokenizer file, with its memo."""
    if key not in _READY:
        _READY.clear()
        _READY[key] = WordBpe(spec.value)
    return _READY[key]


def load_tokenizer(spark: SparkSession, path: str):
    """The tokenizer file's digest and its bytes as a broadcast; refused above ``MAX_FILE_BYTES``."""
    with open(path, "rb") as f:
        spec = f.read(MAX_FILE_BYTES + 1)
    if len(spec) > MAX_FILE_BYTES:
        raise ValueError(f"tokenizer file above {MAX_FILE_BYTES} bytes")
    return hashlib.sha256(spec).hexdigest(), spark.sparkContext.broadcast(spec)


def decoded_texts(texts: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The tokens' texts with a space between two, for rows of ids that end at ``ends``."""
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), texts.take(pa.array(ids)))
    return pc.binary_join(lists, " ")


def bpe_encode(docs: DataFrame, path: str, text: str = "text", decoded: str | None = None) -> DataFrame:
    """All columns plus ``token_ids`` (binary, little-endian unsigned 32-bit) and ``n_tokens`` (long), and with ``decoded``
    a column of that name with the ids decoded again, in the same pass."""
    ship(docs.sparkSession)
    key, spec = load_tokenizer(docs.sparkSession, path)
    fields = [T.StructField("token_ids", T.BinaryType(), False), T.StructField("n_tokens", T.LongType(), False)]
    if decoded:
        fields.append(T.StructField(decoded, T.StringType(), False))

    def fn(enc, texts, _):
        ids, count = enc.encode_array(texts)
        ends = np.r_[0, np.cumsum(count) * 4]
        if ends[-1] < 1 << 31:
            data = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
        else:  # more than a column of a batch holds; Arrow says so
            data = pa.array([ids[a // 4:b // 4].astype("<u4").tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())], pa.binary())
        out = [data, pa.array(count, pa.int64())]
        if decoded:
            out.append(decoded_texts(enc.token_texts, ids, np.cumsum(count)))
        return out

    return add_columns(docs, text, fields, fn, setup=lambda: encoder_of(key, spec))


def bpe_decode(ids: DataFrame, path: str, column: str = "token_ids") -> DataFrame:
    """All columns plus ``decoded`` (string).  A null id list decodes to ''."""
    ship(ids.sparkSession)
    _, spec = load_tokenizer(ids.sparkSession, path)
    src = ids.drop("decoded")
    schema = T.StructType([*src.schema.fields, T.StructField("decoded", T.StringType(), False)])
    at, names = src.columns.index(column), schema.names

    def run(batches):
        claim("bpe_decode")
        texts = token_texts(spec.value)
        for b in slices(batches, column):
            rows = pc.fill_null(b.column(at).cast(pa.large_binary()), b"")
            size = pc.binary_length(rows).to_numpy(zero_copy_only=False)
            raw, _ = buffer_of(rows)
            out = decoded_texts(texts, np.frombuffer(raw.tobytes(), "<u4"), np.cumsum(size) // 4)
            yield pa.RecordBatch.from_arrays([*b.columns, out], names=names)

    return src.mapInArrow(run, schema)
