"""Count tokens with a compiled finite-state transducer.

The tokenizer (lower-cased words, merges inside a word, an end-of-word mark) is turned into a deterministic transducer over characters
whose transitions carry the number of tokens they emit.

*State of a word.*  The merges of a text end in a token that is unique: it is the only one that may follow the last token of what is left
before it, where two tokens may be neighbours if merging their joined symbols gives just these two.  So for a prefix of a word it is enough to keep,
for each of its ends that may still begin a token, the last token before that end and the number of tokens up to it.  These numbers
are kept relative to the smallest of them, and what that one advances by is emitted.  There are finitely many such states.
*State of a text.*  Around it stands the automaton of the splitting pattern: letters, single digits, other marks, contractions.
States and transitions are made when first met and remembered by the worker (``MAX_STATES`` bounds them; beyond it the table starts anew).

*Texts in parallel.*  Texts are cut into chunks.  White space leads from every state to the start, so the state map of a chunk is constant
behind its first white space and needs the incoming state only for what stands before.  All chunks run in step, as lanes of array lookups, from their first white
space on; a scan over the chunks of each text composes the maps: it hands on end states and runs the heads.

Characters are classed and normalised by asking the library about each one once, so tables follow the library.  Texts that are not in normal
form C are normalised by it first; special tokens in a text count one each and cut it.

Defined results: null is an empty text; an empty text has no tokens; rows are independent, repeated ones included.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger.llm.common import named

LIMIT = 2048
CHUNK = 256
LANE_CHARS = 1 << 21
SYMBOLS = 128
MAX_STATES = 200_000
_MORE_STATES = 1 << 14
_EMIT_BITS = 9
START, LETTERS, OTHERS, QUOTE, QUOTE_RV, QUOTE_L = range(6)


def byte_characters() -> dict[int, str]:
    """The visible character that stands for each byte: itself if printable, else the next one from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordMerges:
    """Merges of one word and the states of its prefixes.

    A prefix state is ``(entries, tail, closing)``: entries ``(length of the end, token before it, tokens up to it)`` by falling length, the
    characters of the longest end, and the tokens of the word if it ends here; all counts relative to the smallest.
    """

    def __init__(self, merges: list[tuple[str, str]], vocabulary: dict[str, int], mark: str) -> None:
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.mark = mark
        self.vocabulary = vocabulary
        self.begins: set[str] = set()
        for token in vocabulary:
            plain = token.removesuffix(mark)
            self.begins.update(plain[:i] for i in range(1, len(plain)))
        self.token = list(vocabulary)
        self.number = {t: i for i, t in enumerate(self.token)}
        self.forget()

    def forget(self) -> None:
        self.neighbours: dict[int, bool] = {}
        self.shared: dict = {}

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.mark) and len(token) > len(self.mark):
            plain = token.removesuffix(self.mark)
            return [*plain[:-1], plain[-1] + self.mark]
        return list(token)

    def merge(self, symbols: list[str]) -> list[str]:
        """Join the pair of lowest rank, the first one among equals, until none is left."""
        parts = list(symbols)
        while len(parts) > 1:
            ranks = [self.rank.get(pair, -1) for pair in zip(parts, parts[1:], strict=False)]
            known = [r for r in ranks if r >= 0]
            if not known:
                break
            at = ranks.index(min(known))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, before: int, token: int) -> bool:
        """Whether merging both tokens' symbols gives just these two; ``before`` is -1 at the start of a word."""
        key = (before + 1) << 32 | token
        found = self.neighbours.get(key)
        if found is None:
            parts = [self.token[t] for t in (before, token) if t >= 0]
            found = self.neighbours[key] = self.merge([s for p in parts for s in self.symbols(p)]) == parts
        return found

    def share(self, value):
        """One object for equal values: states have most of their parts in common."""
        return self.shared.setdefault(value, value)

    def step(self, state: tuple, char: str) -> tuple[tuple, int]:
        """The state after one more byte character and the tokens emitted on the way."""
        entries, tail, _ = state
        last = closing = None
        for length, before, count in entries:
            end = tail[len(tail) - length:] + char
            token, marked = self.number.get(end), self.number.get(end + self.mark)
            if last is None and token is not None and self.may_follow(before, token):
                last = (0, token, count + 1)
            if closing is None and marked is not None and self.may_follow(before, marked):
                closing = count + 1
        kept = [(n + 1, before, count) for n, before, count in entries if tail[len(tail) - n:] + char in self.begins]
        kept.append(last)
        base = min(closing, *(count for _, _, count in kept))  # never falls: new counts are old ones plus one
        longest = kept[0][0]
        entries = self.share(tuple(self.share((n, t, c - base)) for n, t, c in kept))
        return self.share((entries, self.share((tail + char)[len(tail) + 1 - longest:]), closing - base)), base


EMPTY_WORD = (((0, -1, 0),), "", 0)


class Transducer:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = json.loads(Path(path).read_text())["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError("made for merges with an end-of-word mark")
        self.library = Tokenizer.from_file(path)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.words = WordMerges(merges, model["vocab"], model["end_of_word_suffix"])
        self.bytes = byte_characters()
        special = sorted((t.content for t in self.library.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.classes: dict[str, str] = {}
        self.normal: dict[str, str] = {}
        self.forget()

    def forget(self) -> None:
        """Start the tables anew, which bounds a worker's memory."""
        self.words.forget()
        self.states: dict[tuple, int] = {}
        self.described: list[tuple] = []
        self.symbol_of = np.full(0x110000, -1, np.int16)
        self.characters: list[str] = []
        self.table = np.full((1024, SYMBOLS), -1, np.int32)
        self.closing = np.zeros(1024, np.int64)
        self.steps: dict[tuple[int, str], tuple[int, int]] = {}
        self.start = self.state((START, EMPTY_WORD, ""))

    # --- single characters -----------------------------------------------------------------------

    def normalised(self, char: str) -> str:
        """What the library's normaliser makes of one character."""
        if char not in self.normal:
            self.normal[char] = self.library.normalizer.normalize_str(char)
        return self.normal[char]

    def kind(self, char: str) -> str:
        """Letter, number, other or space in the splitting pattern."""
        if char not in self.classes:
            def pieces(text: str) -> int:
                return len(self.library.pre_tokenizer.pre_tokenize_str(text))
            if not pieces(char):
                found = "S"
            elif pieces("a" + char) == 1:
                found = "L"
            else:
                found = "N" if pieces(char + char) == 2 else "O"
            self.classes[char] = found
        return self.classes[char]

    def grow(self, word: tuple, char: str) -> tuple[tuple, int]:
        emitted = 0
        for byte in char.encode():
            word, more = self.words.step(word, self.bytes[byte])
            emitted += more
        return word, emitted

    def count_word(self, text: str) -> int:
        word, emitted = self.grow(EMPTY_WORD, text)
        return emitted + word[2]

    # --- automaton of the splitting pattern ------------------------------------------------------

    def move(self, state: tuple, char: str) -> tuple[tuple, int]:
        """One step over a normalised character."""
        mode, word, held = state
        kind = self.kind(char)
        if mode == START:
            if kind == "S":
                return (START, EMPTY_WORD, ""), 0
            if kind == "N":
                return (START, EMPTY_WORD, ""), self.count_word(char)
            word, emitted = self.grow(EMPTY_WORD, char)
            return (LETTERS if kind == "L" else QUOTE if char == "'" else OTHERS, word, ""), emitted
        if (mode, kind) in ((LETTERS, "L"), (OTHERS, "O"), (QUOTE, "O")):
            word, emitted = self.grow(word, char)
            return (LETTERS if mode == LETTERS else OTHERS, word, ""), emitted
        if mode == QUOTE and char in "stmd":
            return (START, EMPTY_WORD, ""), self.count_word("'" + char) - self.grow(EMPTY_WORD, "'")[1]
        if mode == QUOTE and char in "rvl":
            return (QUOTE_L if char == "l" else QUOTE_RV, word, char), 0
        if mode in (QUOTE_RV, QUOTE_L):
            if char == ("l" if mode == QUOTE_L else "e"):
                return (START, EMPTY_WORD, ""), self.count_word("'" + held + char) - self.grow(EMPTY_WORD, "'")[1]
            # No contraction after all: the mark was a word, the held letter begins another.
            begun, emitted = self.grow(EMPTY_WORD, held)
            after, more = self.move((LETTERS, begun, ""), char)
            return after, word[2] + emitted + more
        after, emitted = self.move((START, EMPTY_WORD, ""), char)
        return after, word[2] + emitted

    def close(self, state: tuple) -> int:
        """Tokens emitted where the text ends."""
        mode, word, held = state
        return 0 if mode == START else word[2] + (self.count_word(held) if held else 0)

    # --- compiled tables -------------------------------------------------------------------------

    def state(self, described: tuple) -> int:
        found = self.states.get(described)
        if found is None:
            found = self.states[described] = len(self.described)
            self.described.append(described)
            if found == len(self.table):
                self.table = np.concatenate([self.table, np.full((_MORE_STATES, SYMBOLS), -1, np.int32)])
                self.closing = np.concatenate([self.closing, np.zeros(_MORE_STATES, np.int64)])
            self.closing[found] = self.close(described)
        return found

    def follow(self, state: int, char: str) -> tuple[int, int]:
        """Next state and emitted tokens for a character as it stands in the text."""
        described, emitted = self.described[state], 0
        for c in self.normalised(char):
            described, more = self.move(described, c)
            emitted += more
        return self.state(described), emitted

    def transition(self, state: int, char: str) -> tuple[int, int]:
        """The same, remembered: for texts outside the table."""
        key = (state, char)
        found = self.steps.get(key)
        if found is None:
            found = self.steps[key] = self.follow(state, char)
        return found

    def compile(self, state: int, symbol: int) -> int:
        after, emitted = self.follow(state, self.characters[symbol])
        if emitted >> _EMIT_BITS:
            raise OverflowError("a transition emits more tokens than the table holds")
        self.table[state, symbol] = after << _EMIT_BITS | emitted
        return self.table[state, symbol]

    def symbols(self, points: np.ndarray) -> np.ndarray:
        found = self.symbol_of[points]
        if (found < 0).any():
            for point in np.unique(points[found < 0]).tolist():
                # Characters that normalise alike share a symbol; all white space is symbol 0.
                char = chr(point)
                same = self.normalised(char)
                same = " " if all(self.kind(c) == "S" for c in same) else same
                if same not in self.characters and len(self.characters) < SYMBOLS:
                    if not self.characters:
                        self.characters.append(" ")
                    if same not in self.characters:
                        self.characters.append(same)
                if same in self.characters and self.normalised(same) == same:
                    self.symbol_of[point] = self.characters.index(same)
            found = self.symbol_of[points]
        return found

    def run_lanes(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Run lanes over ``symbols[starts:ends]`` in step; end states and emitted tokens."""
        order = np.argsort(starts - ends, kind="stable")  # the longest first, so that the active lanes are a prefix
        at, lengths = starts[order], (ends - starts)[order]
        now, emitted = state[order].astype(np.int64), np.zeros(len(order), np.int64)
        active = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")
        for i, n in enumerate(active.tolist()):
            read = symbols[at[:n] + i].astype(np.int64)
            packed = self.table[now[:n], read]
            missing = np.flatnonzero(packed < 0)
            if len(missing):
                for s, c in np.unique(np.column_stack([now[missing], read[missing]]), axis=0).tolist():
                    self.compile(s, c)
                packed = self.table[now[:n], read]
            now[:n] = packed >> _EMIT_BITS
            emitted[:n] += packed & ((1 << _EMIT_BITS) - 1)
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return now[back], emitted[back]

    # --- texts -----------------------------------------------------------------------------------

    def count_plain(self, text: str) -> int:
        """One text, character by character: for texts with more kinds of characters than the table has columns."""
        state, total = self.start, 0
        for char in text:
            state, emitted = self.transition(state, char)
            total += emitted
        return total + int(self.closing[state])

    def count_lanes(self, texts: list[str]) -> list[int]:
        """Many texts in normal form C and without special tokens."""
        if max(len(self.described), len(self.steps) // 4) > MAX_STATES:
            self.forget()
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        symbols = self.symbols(points)
        lengths = np.array([len(t) for t in texts])
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        odd = np.unique(np.searchsorted(bounds, np.flatnonzero(symbols < 0), side="right") - 1)
        lengths = lengths.copy()
        lengths[odd] = 0
        pieces = -(-lengths // CHUNK)
        text_of = np.repeat(np.arange(len(texts)), pieces)
        number = np.arange(len(text_of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts = bounds[text_of] + number * CHUNK
        ends = np.minimum(starts + CHUNK, bounds[text_of] + lengths[text_of])
        # Behind the first white space of a chunk; that character itself still emits what the incoming state held.
        spaces = np.append(np.flatnonzero(symbols == 0), len(symbols))
        first = spaces[np.searchsorted(spaces, starts)]
        constant = first < ends
        sync = np.minimum(first + 1, ends)
        sync[number == 0] = starts[number == 0]
        end_state, counts = self.run_lanes(symbols, sync, ends, np.full(len(starts), self.start))
        # The scan: a chunk with a constant map hands its end state on at once; one without waits for its head.
        waiting = np.flatnonzero(number > 0)
        known = constant.copy()
        known[number == 0] = True
        while len(waiting):
            ready = known[waiting - 1]
            now, waiting = waiting[ready], waiting[~ready]
            head_state, head_counts = self.run_lanes(symbols, starts[now], sync[now], end_state[now - 1])
            counts[now] += head_counts
            open_end = ~constant[now]
            end_state[now[open_end]] = head_state[open_end]
            known[now] = True
        totals = np.bincount(text_of, counts, len(texts)).astype(np.int64)
        last = np.cumsum(pieces) - 1
        full = pieces > 0
        totals[full] += self.closing[end_state[last[full]]]
        for i in odd.tolist():
            totals[i] = self.count_plain(texts[i])
        return totals.tolist()

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of whole texts."""
        totals, parts, owner, size = [0] * len(texts), [], [], 0

        def flush() -> None:
            for i, n in zip(owner, self.count_lanes(parts) if parts else [], strict=True):
                totals[i] += n

        for i, text in enumerate(texts):
            pieces = [text or ""]
            if self.special and self.special.search(pieces[0]):
                totals[i] += len(self.special.findall(text))
                pieces = self.special.split(text)
            for piece in pieces:
                if not piece.isascii() and not unicodedata.is_normalized("NFC", piece):
                    piece = self.library.normalizer.normalize_str(piece)
                if piece:
                    parts.append(piece)
                    owner.append(i)
                    size += len(piece)
            if size >= LANE_CHARS:
                flush()
                parts, owner, size = [], [], 0
        flush()
        return totals


_compiled: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for batch in batches:
            counts = machine.count(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = dict(docs.dtypes)["doc_id"]
    text = F.coalesce(named("text"), F.lit(""))
    rows = docs.select(named("doc_id").alias("_id"), text.alias("_text"), F.octet_length(text).cast("long").alias("_bytes"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
