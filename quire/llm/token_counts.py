"""Token counts by compiled finite-state transducers.

Two machines do the work. The splitter is a transducer over character classes whose transitions say where a pre-token
begins; a text is cut into chunks, each chunk becomes a map from entry state to exit state, and the maps are composed by a
parallel prefix scan, so that every chunk then runs from its known entry state. The merger is a transducer over the bytes of
one pre-token, determinised as it is needed: a state holds, for each cut that a later token may start from, the last token of
the byte-pair encoding up to that cut and its relative count, and each transition carries the change of the emitted count.
"""

from __future__ import annotations

import json
import sys
import unicodedata
import uuid
import numpy as np
from pyspark.sql import DataFrame

from quire.llm.common import in_batches, with_texts

CHUNK = 64
BATCH_CHARS = 2_000_000
CACHE_WORDS = 300_000
MAX_STATES = 200_000

# The characters with the Unicode property White_Space.
SPACES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Classes of characters. The letters with a class of their own occur in the contractions 's 't 'm 'd 're 've 'll.
LETTER, NUMBER, OTHER, QUOTE, BLANK, SPACE, SHORT, R, V, L, E, CUT, PAD = range(13)
N_CLASSES = 13
# States of the splitter: what stands before the next character.
BEGIN, IN_LETTERS, IN_NUMBERS, IN_OTHERS, BLANK_1, BLANKS, SPACE_1, SPACES_N, QUOTED, QUOTE_R, QUOTE_V, QUOTE_L, CLOSED = range(13)
N_STATES = 13
HERE, BEFORE = 1, 2  # a pre-token begins at this character, at the one before it


def character_classes() -> np.ndarray:
    """The class of each code point."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for code in range(sys.maxunicode + 1):
        major = unicodedata.category(chr(code))[0]
        if major == "L":
            table[code] = LETTER
        elif major == "N":
            table[code] = NUMBER
    table[SPACES] = SPACE
    table[ord(" ")] = BLANK
    table[ord("'")] = QUOTE
    for letters, kind in (("stmd", SHORT), ("r", R), ("v", V), ("l", L), ("e", E)):
        for letter in letters:
            table[ord(letter)] = kind
    return table


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission of each (state, class)."""
    letters = {LETTER, SHORT, R, V, L, E}
    run_of = {**dict.fromkeys(letters, IN_LETTERS), NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: IN_OTHERS}
    waiting = {QUOTE_R: E, QUOTE_V: E, QUOTE_L: L}
    step = np.zeros((N_STATES, N_CLASSES), np.uint8)
    emit = np.zeros((N_STATES, N_CLASSES), np.uint8)
    for state in range(N_STATES):
        late = BEFORE if state in waiting else 0  # the letter after the quote begins a pre-token after all
        for kind in range(N_CLASSES):
            if kind == PAD:
                nxt, out = state, 0
            elif kind == CUT:
                nxt, out = BEGIN, late
            elif kind in (BLANK, SPACE):
                if state in (BLANK_1, BLANKS, SPACE_1, SPACES_N):
                    nxt, out = (BLANKS if kind == BLANK else SPACES_N), 0
                else:
                    nxt, out = (BLANK_1 if kind == BLANK else SPACE_1), HERE | late
            elif state == QUOTED and kind in (SHORT, R, V, L):
                nxt, out = {SHORT: CLOSED, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[kind], 0
            elif state in waiting and kind == waiting[state]:
                nxt, out = CLOSED, 0
            else:
                run = run_of[kind]
                before = {QUOTED: IN_OTHERS, QUOTE_R: IN_LETTERS, QUOTE_V: IN_LETTERS, QUOTE_L: IN_LETTERS}.get(state, state)
                if state in (BLANK_1, BLANKS):
                    out = BEFORE if state == BLANKS else 0
                elif before == run:
                    out = late
                else:
                    out = HERE | late | (BEFORE if state == SPACES_N else 0)
                nxt = QUOTED if kind == QUOTE and out & HERE else run
            step[state, kind], emit[state, kind] = nxt, out
    return step, emit


class Splitter:
    """Where the pre-tokens of a text begin."""

    def __init__(self):
        self.classes = character_classes()
        self.step, self.emit = splitter()
        self.width = N_CLASSES * N_CLASSES
        # Two characters at a time, by (state, first class, second class); the next state stands times width, ready as an index.
        self.two = self.step[self.step].ravel().astype(np.intp) * self.width
        self.next = self.step.ravel().astype(np.intp) * N_CLASSES
        self.flag = self.emit.ravel()

    def starts(self, text: str, cuts: np.ndarray) -> np.ndarray:
        """Positions in text where a pre-token begins; at the positions in cuts a text ends, and the next one begins after."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kinds = self.classes[points]
        kinds[cuts] = CUT
        n = len(kinds)
        rows = -(-n // CHUNK)
        grid = np.full(rows * CHUNK, PAD, np.uint8)
        grid[:n] = kinds
        grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
        maps = np.repeat(np.arange(N_STATES, dtype=np.intp)[:, None] * self.width, rows, axis=1)
        for k in range(0, CHUNK, 2):
            maps = np.take(self.two, maps + (grid[k].astype(np.intp) * N_CLASSES + grid[k + 1]))
        state = self.scan(np.ascontiguousarray((maps // self.width).T)).astype(np.intp) * N_CLASSES
        flags = np.empty((CHUNK, rows), np.uint8)
        for k in range(CHUNK):
            at = state + grid[k]
            flags[k] = np.take(self.flag, at)
            state = np.take(self.next, at)
        flags = flags.T.ravel()[:n]
        begins = (flags & HERE).astype(bool)
        begins[:-1] |= (flags[1:] & BEFORE).astype(bool)
        return np.flatnonzero(begins)

    @staticmethod
    def scan(maps: np.ndarray) -> np.ndarray:
        """The state in which each chunk is entered: exclusive prefix composition of the chunks' maps, by doubling."""
        total = maps.astype(np.intp)
        reach = 1
        while reach < len(total):
            total[reach:] = np.take_along_axis(total[reach:], total[:-reach].copy(), axis=1)
            reach *= 2
        entry = np.empty(len(total), np.uint8)
        entry[0] = BEGIN
        entry[1:] = total[:-1, BEGIN]
        return entry


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, by its rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Merger:
    """Counts the tokens of one pre-token by a transducer that is determinised as it is needed."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank: dict[tuple[bytes, bytes], int] = {}
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        self.made: dict[bytes, int] = {}
        for r, (a, b) in enumerate(pairs):
            a, b = as_bytes(a), as_bytes(b)
            self.rank.setdefault((a, b), r)
            if a + b not in self.made:
                self.parts[a + b], self.made[a + b] = (a, b), r
        self.whole: dict[bytes, bool] = {}
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        # Spines: the tokens that end (begin) a token, from its single byte up to itself, with the rank of the merge that made each.
        self.right_spine: dict[bytes, list] = {}
        self.left_spine: dict[bytes, list] = {}
        tokens = [bytes([b]) for b in range(256)] + list(self.made)
        self.tokens: set[bytes] = set()
        for t in tokens:  # by rank, so that parts come first
            self.right_spine[t], self.left_spine[t] = self._spine(t, 1), self._spine(t, 0)
            a, b = self.parts.get(t, (t, b""))
            if not b or a in self.tokens and b in self.tokens and self.adjacent(a, b, self.made[t]):
                self.tokens.add(t)
        self.prefixes: set[bytes] = {t[:k] for t in self.tokens for k in range(1, len(t) + 1)}
        self.longest = max(map(len, self.tokens))
        self.reset()

    def _spine(self, token: bytes, side: int) -> list:
        if token not in self.parts:
            return [(token, -1)]
        below = self.parts[token][side]
        return [*(self.right_spine if side else self.left_spine)[below], (token, self.made[token])]

    def adjacent(self, left: bytes, right: bytes, until: int | None = None) -> bool:
        """Whether the encoding of left + right keeps them apart (until a merge of that rank). It replays the merges along the
        border by rank; of equal ranks the leftmost merge comes first."""
        never = 1 << 60
        limit = never if until is None else until
        ups, downs = self.right_spine[left], self.left_spine[right]
        i = j = 0
        rank = self.rank
        while True:
            across = rank.get((ups[i][0], downs[j][0]), never)
            up = ups[i + 1][1] if i + 1 < len(ups) else never
            down = downs[j + 1][1] if j + 1 < len(downs) else never
            if across < limit and across < up and across <= down:
                return False
            if up == never and down == never:
                return True
            if up <= down:
                i += 1
            else:
                j += 1

    def compatible(self, left: bytes, right: bytes) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            known = self.fits[left, right] = self.adjacent(left, right)
        return known

    def reset(self) -> None:
        """Forgets the states found so far: their number is bounded, as any of them can be made again."""
        # A state: the bytes since the earliest cut that matters, and for each cut its last token and count relative to the newest.
        self.states: list[tuple[bytes, tuple]] = [(b"", ((b"", 0),))]
        self.ids: dict[tuple[bytes, tuple], int] = {self.states[0]: 0}
        self.moves: dict[int, tuple[int, int]] = {}
        self.fits.clear()

    def move(self, state: int, byte: int) -> tuple[int, int]:
        """The next state and the change of the count."""
        window, cuts = self.states[state]
        text = window + bytes([byte])
        for start in range(len(text)):  # the longest token first: its start is the earliest cut
            token = text[start:]
            if token in self.tokens:
                last, count = cuts[start]
                if not last or self.compatible(last, token):
                    break
        else:
            raise ValueError("a byte without a token")
        change = count + 1
        cuts = (*cuts, (token, change))
        keep = 0
        while text[keep:] not in self.prefixes:
            keep += 1
        key = (text[keep:], tuple((t, c - change) for t, c in cuts[keep:]))
        found = self.ids.get(key)
        if found is None:
            found = self.ids[key] = len(self.states)
            self.states.append(key)
        self.moves[state << 8 | byte] = (found, change)
        return found, change

    def count(self, piece: bytes) -> int:
        """The number of tokens of a pre-token. However long it is, no more than about MAX_STATES states are kept."""
        state = total = 0
        moves = self.moves
        for byte in piece:
            found = moves.get(state << 8 | byte)
            if found is None:
                if len(self.states) > MAX_STATES or len(self.fits) > MAX_STATES:
                    here = self.states[state]
                    self.reset()
                    state = self.ids.setdefault(here, len(self.states))
                    self.states[state:] = [here]
                    moves = self.moves
                found = self.move(state, byte)
            state, change = found
            total += change
        return total


def refuse_others(content: dict) -> None:
    """Raises for a vocabulary file with a setting that the transducers do not follow."""
    splitter, model = content.get("pre_tokenizer") or {}, content["model"]
    bad = [f"model {k}" for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    bad += ["normalizer"] * bool(content.get("normalizer")) + ["model type"] * (model.get("type", "BPE") != "BPE")
    bad += ["pre_tokenizer"] * (splitter.get("type") != "ByteLevel" or bool(splitter.get("add_prefix_space", True)) or not splitter.get("use_regex", True))
    for token in content.get("added_tokens") or []:
        flags = [k for k in ("single_word", "lstrip", "rstrip", "normalized") if token.get(k)] + ["not special"] * (not token.get("special", True))
        bad += [f"added token {token['content']}: {', '.join(flags)}"] * bool(flags)
    if bad:
        raise ValueError(f"not supported in a vocabulary file: {'; '.join(bad)}")


class TokenCounter:
    """Counts of whole texts, equal to those of the library for the vocabulary file (a byte-level BPE, .json)."""

    def __init__(self, definition: str):
        content = json.loads(definition)
        refuse_others(content)
        model = content["model"]
        self.special = [t["content"] for t in content.get("added_tokens") or []]
        self.splitter = Splitter()
        self.merger = Merger(model["vocab"], model["merges"])
        self.cache: dict[str, int] = {}

    def counts(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        parts: list[str] = []
        owner: list[int] = []
        for i, text in enumerate(texts):
            pieces = [text]
            for special in self.special:
                if special in text:
                    pieces = [q for p in pieces for q in p.split(special)]
                    # each occurrence is one token
            out[i] += len(pieces) - 1
            for p in pieces:
                if p:
                    parts.append(p)
                    owner.append(i)
        at = 0
        for batch in in_batches(parts, BATCH_CHARS):
            np.add.at(out, owner[at : at + len(batch)], self._batch(batch))
            at += len(batch)
        return out

    def _batch(self, texts: list[str]) -> np.ndarray:
        joined = "\n".join(texts) + "\n"
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = self.splitter.starts(joined, ends)
        first = np.searchsorted(starts, np.concatenate([[0], ends[:-1] + 1]))
        stops = np.append(starts[1:], len(joined))
        last = np.append(first[1:], len(starts)) - 1
        stops[last] = ends
        cache = self.cache
        found = [cache.get(joined[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
        numbers = np.array([-1 if x is None else x for x in found], np.int64)
        count = self.merger.count
        for k in np.flatnonzero(numbers < 0).tolist():
            piece = joined[starts[k] : stops[k]]
            value = cache.get(piece)
            if value is None:
                value = count(piece.encode())
                if len(piece) < 64:
                    if len(cache) >= CACHE_WORDS:
                        cache.clear()
                    cache[piece] = value
            numbers[k] = value
        return np.add.reduceat(numbers, first)


_COUNTERS: dict[str, TokenCounter] = {}  # one a Python worker, kept between tasks


def token_counts(df: DataFrame, tokenizer_path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """df's columns but the text, with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    tokenizer_path is read on the driver and sent to the executors. A null or empty text has 0 bytes and 0 tokens; strings of
    special tokens inside a text are one token each, as by the library's default. No text is cut; repeated rows stay.
    A column of df named like a result is replaced.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = df.sparkSession.sparkContext.broadcast(file.read())
    own = uuid.uuid4().hex

    def start():
        counter = _COUNTERS.get(own)
        if counter is None:
            _COUNTERS.clear()
            counter = _COUNTERS[own] = TokenCounter(shared.value)

        def apply(texts: list[str | None]) -> list:
            texts = [t or "" for t in texts]
            tokens = counter.counts(texts)
            return [np.array([len(t.encode()) for t in texts], np.int64), tokens, tokens > limit]

        return apply

    return with_texts(df, text, "n_bytes long, n_tokens long, over_limit boolean", start)
