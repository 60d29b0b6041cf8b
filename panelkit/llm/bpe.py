"""BPE encoding and decoding by a tokenization automaton.

The automaton reads token labels. It starts with one state and a loop for each
base symbol, and takes in the merges by rank. The gadget of a merge (u, v) -> w:
every arc labelled u is led to a copy of its target without the arc v, and every
state with an arc u gets an arc w to where u, v led. What it accepts after the
last merge are just the label sequences that BPE makes, one for each word.

All arcs of a label lead to one state, so a state goes by the label that leads to
it, and a gadget costs one row: u's state loses the arc v at the merge's rank.
A new label's state starts as that of its right part v stood at that rank, and a
state has an arc w if it had the arc of w's left part u at that rank. So whether
a state has an arc follows from the rows of the right parts of the state's label
and the left parts of the arc's. Found arcs are kept in a transition table.

A word is read left to right, trying the arcs of a state by the length of their
label, longest first, and going back where a state has no arc that fits. The
labels that begin at a place are a chain, each leading to the next shorter one.
Every prefix of a word has one accepted sequence, so no place is visited twice.
Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from hashlib import sha256
from struct import pack
from unicodedata import category
from unicodedata import normalize as compose

import numpy as np
import regex
from pyspark.sql import DataFrame

from panelkit.llm.common import map_columns, text_or_empty

#: Words whose arcs a task remembers (up to twice as many), entries of its transition table, and the longest word remembered.
REMEMBER_WORDS = 200_000
REMEMBER_ARCS = 500_000
REMEMBER_LENGTH = 64
#: Letters of a text whose words are split at a time, up to the next blank.
PIECE = 1_000_000

#: Fixed values of the tokenizer family: special tokens, word end, and the pattern of words.
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
WORD_END = "</w>"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The pattern for lower-case ASCII; what begins a word tells which alternative fits.
ASCII_PATTERN = r"[a-z]+|[0-9]|'(?:[stmd]|[rv]e|ll)|[^\x09-\x0D\x20a-z0-9]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256))
    return [chr(b) if b in own else chr(256 + next(spare)) for b in range(256)]


class Automaton:
    """Compiled from a vocabulary and merges in the order of their rank."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int],
                 name: str = "", rules: str | None = None):
        #: The file's digest, and its rules for normalizing and splitting, as the library reads them.
        self.name, self.rules = name, rules
        n = max([*vocab.values(), *special.values()]) + 1
        self.labels = [""] * n
        for token, i in [*vocab.items(), *special.items()]:
            self.labels[i] = token
        self.special = special
        self.left, self.right, self.made = [-1] * n, [-1] * n, [-1] * n
        #: The arcs lost by a state: (its label, the arc's label) as one number, to the rank of the merge.
        self.lost: dict[int, int] = {}
        alive = [False] * n
        letters = {x: bytes([b]) for b, x in enumerate(byte_letters())}
        for token, i in vocab.items():
            alive[i] = len(token.removesuffix(WORD_END)) == 1
        for rank, (u, v) in enumerate((vocab[a], vocab[b]) for a, b in merges):
            w = vocab[self.labels[u] + self.labels[v]]
            if self.made[w] < 0 and alive[u] and alive[v] and self.has_arc(u, v):
                alive[w], self.left[w], self.right[w], self.made[w] = True, u, v, rank
                self.lost[u * n + v] = rank
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in vocab.items():
            if alive[i]:
                kind = self.final if token.endswith(WORD_END) else self.inner
                kind[b"".join(letters[c] for c in token.removesuffix(WORD_END))] = i
        self.longest = max(map(len, [*self.inner, *self.final]))
        #: Beginnings of inner labels, to the longest inner label that begins them, and the next shorter one of each
        #: label. Where a beginning is missing, no longer label fits.
        self.begins: dict[bytes, int] = {}
        self.shorter, self.size = [-1] * n, [0] * n
        for x, i in sorted(self.inner.items(), key=lambda item: len(item[0])):
            self.size[i] = len(x)
            for k in range(1, len(x)):
                self.begins.setdefault(x[:k], self.begins.get(x[:k - 1], -1))
            self.shorter[i] = self.begins.get(x[:-1], -1)
            self.begins[x] = i

    def has_arc(self, state: int, label: int) -> bool:
        """Whether the state to which the arcs of one label lead has an arc of the other."""
        n, lost, made = len(self.labels), self.lost, self.made
        until = len(lost) + len(self.labels)  # beyond any rank
        while state >= 0:
            at, before = label, until
            while at >= 0:
                rank = lost.get(state * n + at)
                if rank is not None and rank < until and rank <= before:
                    return False
                at, before = self.left[at], made[at]
            until, state = made[state], self.right[state]
        return True

    def encoder(self) -> Callable[[bytes], list[int]]:
        """A function from the bytes of a word to the labels of its arcs, with its own transition table."""
        table: dict[int, bool] = {}
        final, begins, shorter, sizes = self.final, self.begins, self.shorter, self.size
        longest, n, has_arc = self.longest, len(self.labels), self.has_arc

        def fits(state: int, label: int) -> bool:
            if len(table) > REMEMBER_ARCS:
                table.clear()
            arc = table[state * n + label] = has_arc(state, label)
            return arc

        def encode(word: bytes) -> list[int]:
            size = len(word)
            out: list[int] = []
            at, state = 0, -1
            while True:
                if size - at <= longest:
                    label = final.get(word[at:])
                    if label is not None:
                        arc = state < 0 or table.get(state * n + label)
                        if fits(state, label) if arc is None else arc:
                            out.append(label)
                            return out
                label, end = -1, at + 1
                while end < size:
                    longer = begins.get(word[at:end])
                    if longer is None:
                        break
                    label = longer
                    end += 1
                while True:
                    while label >= 0 and state >= 0:
                        arc = table.get(state * n + label)
                        if fits(state, label) if arc is None else arc:
                            break
                        label = shorter[label]
                    if label >= 0:
                        break
                    label = out.pop()  # back to the place before
                    at -= sizes[label]
                    label, state = shorter[label], out[-1] if out else -1
                out.append(label)
                at, state = at + sizes[label], label

        return encode


def load(path: str) -> Automaton:
    """Compile the automaton of a tokenizer file (the JSON of the public tokenizers library)."""
    with open(path, "rb") as f:
        data = f.read()
    spec = json.loads(data)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    rules = json.dumps(spec | {"added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}})
    return Automaton(spec["model"]["vocab"], merges, {t["content"]: t["id"] for t in spec["added_tokens"]},
                     sha256(data).hexdigest(), rules)


def normalize(text: str) -> str:
    """Canonical composition, then lower case letter by letter (no final sigma)."""
    if text.isascii():
        return text.lower()
    return compose("NFC", text).replace("Σ", "σ").lower()


def pieces(text: str) -> Iterable[str]:
    """The text cut before blanks, which no word spans and no letter composes with."""
    at = 0
    while at >= 0:
        end = text.find(" ", at + PIECE)
        yield text[at:end] if end >= 0 else text[at:]
        at = end


class Remembered(dict):
    """What a function made of the words it was asked for lately: at least the last REMEMBER_WORDS new ones."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.before = make, {}

    def __missing__(self, word: str) -> bytes:
        value = self.before.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= REMEMBER_LENGTH:
            if len(self) >= REMEMBER_WORDS:
                self.before = dict(self)
                self.clear()
            self[word] = value
        return value


class Tokenizer:
    """Encodes and decodes texts with one automaton.

    Made anew in each task, so that idle Python workers hold none. Remembers the words it has read. A text is split
    as a whole, not run by run, so that a word costs one look-up in whatever punctuation and case it stands.
    """

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.encode_word = automaton.encoder()
        self.find, self.find_ascii = regex.compile(PATTERN).findall, re.compile(ASCII_PATTERN).findall
        self.split = regex.compile("(" + "|".join(map(regex.escape, automaton.special)) + ")").split \
            if automaton.special else lambda text: [text]
        self.words = Remembered(self._word)
        self.labels = [x.encode("utf-8") for x in automaton.labels]
        #: Letters met so far that Python's Unicode tables hold.
        self.known: set[str] = set()
        self.library = None

    def _word(self, word: str) -> bytes:
        ids = self.encode_word(word.encode("utf-8", "surrogatepass"))
        return pack(f"<{len(ids)}I", *ids)

    def _unknown(self, text: str) -> bool:
        """Whether letters occur that Unicode got lately."""
        met = set(text) - self.known
        new = {c for c in met if category(c) == "Cn"}
        self.known |= met - new
        return bool(new)

    def _split(self, text: str) -> list[str]:
        """Words of a text. Runs with letters that Unicode got lately are left to the library's own tables."""
        if text.isascii():
            return self.find_ascii(text.lower())
        if self.automaton.rules is None or not self._unknown(text):
            return self.find(normalize(text))
        # four control characters part words in Python, but not in the tokenizer
        runs = [text] if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        return [w for run in runs for w in (self._split_by_library if self._unknown(run) else self._split)(run)]

    def _split_by_library(self, run: str) -> list[str]:
        if self.library is None:
            import tokenizers
            self.library = tokenizers.Tokenizer.from_str(self.automaton.rules)
        letters = {x: b for b, x in enumerate(byte_letters())}
        normal = self.library.normalizer.normalize_str(run)
        return [bytes(letters[c] for c in w).decode("utf-8")
                for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for part in self.split(text) if "<|" in text else [text]:
            if part in self.automaton.special:
                out.append(pack("<I", self.automaton.special[part]))
            else:
                out.extend(b"".join(map(self.words.__getitem__, self._split(piece))) for piece in pieces(part))
        return b"".join(out)

    def decode(self, ids: Iterable[int]) -> str:
        """The labels of the arcs, parted by spaces."""
        return self.decode_utf8(ids).decode("utf-8")

    def decode_utf8(self, ids: Iterable[int]) -> bytes:
        return b" ".join(map(self.labels.__getitem__, ids))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each whole text of ``docs``.

    The automaton is compiled once on the driver from the file at ``path`` and shipped to the tasks (its
    size is that of the vocabulary). A null or empty text has no tokens. Repeated rows each give a row, an
    empty table gives none; columns other than doc_id and text are ignored.
    """
    automaton = load(path)

    def make():
        tokenizer = Tokenizer(automaton)

        def row(text: str) -> tuple:
            data = tokenizer.encode(text)
            decoded = tokenizer.decode_utf8(np.frombuffer(data, "<u4").tolist())
            return len(data) // 4, sha256(data).hexdigest(), sha256(decoded).hexdigest()

        return row

    rows = docs.select("doc_id", text_or_empty().alias("text_in"))
    return map_columns(rows, make, "n_tokens long, ids_sha256 string, decoded_sha256 string", ["doc_id"], ["text_in"])


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids``: the token ids themselves, as an array."""
    automaton = load(path)

    def make():
        tokenizer = Tokenizer(automaton)
        return lambda text: (np.frombuffer(tokenizer.encode(text), "<u4").tolist(),)

    rows = docs.select("doc_id", text_or_empty().alias("text_in"))
    return map_columns(rows, make, "ids array<long>", ["doc_id"], ["text_in"])


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, text``: what the ids of ``rows`` (doc_id, ids) stand for; null ids give the empty text."""
    automaton = load(path)

    def make():
        tokenizer = Tokenizer(automaton)
        return lambda ids: (tokenizer.decode(ids or []),)

    return map_columns(rows, make, "text string", ["doc_id"], ["ids"])
