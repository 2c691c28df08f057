"""Text that was decoded with another encoding than it was written in.

A hidden Markov model labels the characters of a text. It has one clean state and one state for each encoding pair
(written in, read as), for UTF-8 misread twice over, and for readings that dropped bytes. Two misreadings of which one
is between single-byte encodings have no state. A state emits a stretch with
the probability that a character model of clean text gives to its inverse transform; all states emit ASCII alike, and
changes of state fall between words. The model of clean text is fitted by expectation maximisation in its hard form: character n-grams are
counted over all words of all documents, words are labelled, and the n-grams of those labelled clean are counted again.
Each stretch labelled with a pair is then replaced by that state's inverse transform.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vdjlake.storage import cut, discard

#: Single-byte encodings that texts of European languages are written in or mistaken for; fixed values.
SINGLE_BYTE = (
    "cp1252", "latin_1", "mac_roman", "cp850", "cp437", "cp1251", "koi8_r", "cp866",
    "cp1250", "iso8859_2", "iso8859_5", "iso8859_15", "cp1254", "mac_cyrillic",
)
#: Readers that leave bytes undefined or as control characters, which are often dropped afterwards.
DROPPING = ("cp1252", "latin_1", "cp1250", "cp1251")
LOST = "lost"
ORDERS, SLOTS = (2, 3, 4), 1 << 19
SMOOTHING = 1.5
#: What a letter that was never seen counts, and the sum of these.
UNSEEN, FLOOR = 0.05, 200
ROUNDS = 2
CACHE = 200_000  # words that a worker remembers
WORD = r"[^ \t\r\n]+"
SEPARATORS = r"[ \t\r\n]+"
#: Between single-byte encodings, a word doesn't become blank or control characters.
BLANK = re.compile(r"[\s\x00-\x1f\x7f-\xa0\xad]")


@lru_cache(maxsize=None)
def reader_table(encoding: str) -> tuple[str, ...]:
    """The character of each byte; undefined bytes read as the control character of the same number."""
    return tuple(bytes([b]).decode(encoding, "ignore") or chr(b) for b in range(256))


@lru_cache(maxsize=None)
def byte_of(encoding: str) -> dict[str, int]:
    return {c: b for b, c in enumerate(reader_table(encoding))}


def misread(text: str, written: str, read: str, drop: bool = False) -> str:
    """``text`` written in one encoding and read as another; ``drop``: without control characters in the result."""
    out = "".join(reader_table(read)[b] for b in text.encode(written))
    return "".join(c for c in out if not "\x80" <= c <= "\x9f") if drop else out


def unread(text: str, written: str, read: str) -> str | None:
    """The inverse of ``misread``; None where ``text`` can't have come about so."""
    table = byte_of(read)
    try:
        raw = bytes([table[c] for c in text])
    except KeyError:
        return None
    if written == "utf_8":
        try:
            return raw.decode("utf-8")
        except UnicodeDecodeError:
            return None
    return "".join(reader_table(written)[b] for b in raw)


def fold_digits(word: str) -> str:
    return re.sub(r"\d", "0", word.lower())


def _slot(gram: str) -> int:
    return zlib.crc32(gram.encode("utf-8", "surrogatepass")) % SLOTS


class CleanModel:
    """Character n-grams of words that hold a character beyond ASCII, in tables of fixed size."""

    def __init__(self, tables: dict[int, np.ndarray], letters: dict[str, int]):
        self.tables = {k: t.tolist() for k, t in tables.items()}
        self.letters = letters
        self.total = max(1, sum(letters.values()))
        beyond = sum(n for c, n in letters.items() if ord(c) > 127)
        # characters that make up a hundred-thousandth of those beyond ASCII, at least; decodings to others don't count
        self.alphabet = frozenset(c for c, n in letters.items() if ord(c) > 127 and n >= max(2, beyond * 1e-5))
        self.surprise = -log(UNSEEN / (self.total + FLOOR))
        self.memo: dict[str, float] = {}

    def log_probability(self, word: str) -> float:
        known = self.memo.get(word)
        if known is not None:
            return known
        text = f"\x02\x02\x02{fold_digits(word)}\x03"
        total = 0.0
        two, three, four = self.tables[2], self.tables[3], self.tables[4]
        for i in range(3, len(text)):
            p = (self.letters.get(text[i], 0) + UNSEEN) / (self.total + FLOOR)
            for table, k in ((two, 1), (three, 2), (four, 3)):
                context = text[i - k : i]
                n = table[_slot(context + "\x00" * 1)]  # how often the context stands before anything
                p = (table[_slot(context + text[i])] + SMOOTHING * p) / (n + SMOOTHING) if n else p
            total += log(p)
        total += _shape(word)
        if len(self.memo) > CACHE:
            self.memo.clear()
        self.memo[word] = total
        return total


@lru_cache(maxsize=None)
def _script(letter: str) -> str:
    """First word of the name of a letter: its script. Symbols named after a letter, such as micro, are of none."""
    name = unicodedata.name(letter, "")
    return name.split(" ")[0] if name.startswith(("LATIN", "CYRILLIC")) else ""


def _shape(word: str) -> float:
    """Log probability of the pattern of small and capital letters."""
    letters = [c for c in word if c.isalpha()]
    scripts = {_script(c) for c in letters} - {""}
    cost = -4.0 if len(scripts) > 1 else 0.0
    if len(letters) < 2 or word.islower():
        return cost
    if word.isupper() or word.istitle():
        return cost - 1.0
    flips = sum(a.islower() and b.isupper() for a, b in zip(letters, letters[1:]))
    return cost - (2.0 if flips <= 1 and letters[0].isupper() else 4.0 if flips <= 1 else 6.0)


class Pieces:
    """How each letter looks after a reading that dropped control characters."""

    def __init__(self, steps: tuple[str, ...], alphabet: frozenset[str]):
        self.of: dict[str, list[str]] = {}
        for c in sorted(alphabet):
            piece = c
            try:
                for i, read in enumerate(steps):
                    piece = misread(piece, "utf_8", read, drop=i == len(steps) - 1)
            except UnicodeEncodeError:
                continue
            if piece:
                self.of.setdefault(piece, []).append(c)
        self.longest = max(map(len, self.of), default=0)
        self.characters = frozenset("".join(self.of))

    def decode(self, word: str, model: CleanModel) -> tuple[float, str] | None:
        """The likeliest original of ``word`` (found with a beam over its pieces), or None."""
        beams: dict[int, list[str]] = {0: [""]}
        for i in range(len(word)):
            heads = beams.pop(i, None)
            if not heads:
                continue
            if len(heads) > 8:
                heads = sorted(set(heads), key=lambda h: -model.log_probability(h))[:8]
            if ord(word[i]) < 128:
                beams.setdefault(i + 1, []).extend(h + word[i] for h in heads)
                continue
            for n in range(1, self.longest + 1):
                for c in self.of.get(word[i : i + n], ()) if i + n <= len(word) else ():
                    beams.setdefault(i + n, []).extend(h + c for h in heads)
        ends = set(beams.get(len(word), ())) - {word}
        if not ends:
            return None
        best = max(sorted(ends), key=model.log_probability)
        return model.log_probability(best), best


class States:
    """The garbled states, in order of preference among equals, and what they make of a word."""

    def __init__(self, model: CleanModel, active: frozenset[str] | None = None):
        self.model = model
        wanted = lambda name: active is None or name in active
        self.utf8 = [r for r in SINGLE_BYTE if wanted(f"utf_8>{r}") or any(wanted(f"utf_8>{r}>{s}") for s in SINGLE_BYTE) or any(wanted(f"utf_8>{s}>{r}") for s in SINGLE_BYTE)]
        self.single = [(w, r) for w in SINGLE_BYTE for r in SINGLE_BYTE if w != r and wanted(f"{w}>{r}")]
        self.wanted = wanted
        self.readers = {r: frozenset(byte_of(r)) for r in SINGLE_BYTE}
        self.pairs = {(w, r): self._inverse(w, r) for w, r in self.single}
        steps = [(r,) for r in DROPPING] + [(r, s) for r in SINGLE_BYTE for s in DROPPING]
        self.lossy = {">".join(("utf_8", *s, "dropped")): Pieces(s, model.alphabet) for s in steps if wanted(">".join(("utf_8", *s, "dropped")))}

    def _inverse(self, written: str, read: str) -> tuple[frozenset[str], dict[int, str]]:
        """The characters beyond ASCII whose inverse is plausible in a word, and all inverses."""
        back = {c: reader_table(written)[b] for c, b in byte_of(read).items() if ord(c) > 127}
        return frozenset(c for c, x in back.items() if self.plausible(x) and not BLANK.search(x)), {ord(c): x for c, x in back.items()}

    def plausible(self, text: str) -> bool:
        return all(ord(c) < 128 or c in self.model.alphabet for c in text.lower())

    def decodings(self, word: str) -> dict[str, tuple[str, float]]:
        """state -> (decoded word, log-likelihood ratio against clean); equal decodings stay with the first state."""
        if n := word.count("�"):
            # the state emits the character for sure, the clean one as any that it never has
            return {LOST: (word, n * self.model.surprise)}
        found: dict[str, str] = {}
        seen: set[str] = set()
        beyond = frozenset(c for c in word if ord(c) > 127)

        def keep(name: str, text: str) -> None:
            if text not in seen and text != word and self.wanted(name) and self.plausible(text) and (name.startswith("utf_8") or not BLANK.search(text)):
                seen.add(text)
                found[name] = text

        fits = {r for r in SINGLE_BYTE if beyond <= self.readers[r]}
        once = [(r, t) for r in self.utf8 if r in fits and (t := unread(word, "utf_8", r)) is not None]
        for r, t in once:
            keep(f"utf_8>{r}", t)
        for r, t in once:
            inner = frozenset(c for c in t if ord(c) > 127)
            for q in self.utf8 if inner else ():
                if inner <= self.readers[q] and (u := unread(t, "utf_8", q)) is not None:
                    keep(f"utf_8>{q}>{r}", u)
        for (w, r), (good, back) in self.pairs.items():
            if beyond <= good:
                keep(f"{w}>{r}", word.translate(back))
        clean = self.model.log_probability(word)
        out = {s: (t, self.model.log_probability(t) - clean) for s, t in found.items()}
        if not any(g > 3 for _, g in out.values()):
            for name, pieces in self.lossy.items():
                if beyond <= pieces.characters and (best := pieces.decode(word, self.model)):
                    out[name] = (best[1], best[0] - clean)
        return out


def first_cost(state: str) -> float:
    """Cost of leaving the clean state before anything is known of how often a pair occurs."""
    if state == LOST:
        return 1.0
    if state.endswith("dropped"):
        return 6.0
    return 2.5 if state.startswith("utf_8") else 4.5


def enter_cost(state: str, cost: dict[str, float]) -> float:
    return cost.get(state, first_cost(state) + 3.0)


def label(words: list[dict[str, tuple[str, float]]], cost: dict[str, float]) -> list[str | None]:
    """The likeliest states of a text's words beyond ASCII (Viterbi); None is clean."""
    names = sorted({s for d in words for s, (_, g) in d.items() if g > 0})
    if not names:
        return [None] * len(words)
    enter = {s: enter_cost(s, cost) for s in names}
    leave, stay = 0.5, 0.1
    score: dict[str | None, float] = {None: 0.0, **{s: -enter[s] for s in names}}
    back: list[dict[str | None, str | None]] = []
    for i, d in enumerate(words):
        if i:
            best = max(score, key=lambda s: (score[s], s is None))
            previous, score, came = score, {}, {}
            for s in (None, *names):
                options = [(previous[s] - (0.0 if s is None else stay), s)]
                options.append((previous[best] - (0.0 if best is None else leave) - (0.0 if s is None else enter[s]), best))
                if s is not None:
                    options.append((previous[None] - enter[s], None))
                score[s], came[s] = max(options, key=lambda o: o[0])
            back.append(came)
        for s in names:
            score[s] += d[s][1] if s in d else -60.0
    at = max(score, key=lambda s: (score[s], s is None))
    path = [at]
    for came in reversed(back):
        at = came[at]
        path.append(at)
    return path[::-1]


def _ngram_rows(words: Iterator[tuple[str, int]]) -> pd.DataFrame:
    grams: Counter = Counter()
    for word, n in words:
        text = f"\x02\x02\x02{fold_digits(word)}\x03"
        for i in range(3, len(text)):
            grams[1, text[i], 0] += n
            for k in ORDERS:
                context = text[i - k + 1 : i]
                grams[k, "", _slot(context + text[i])] += n
                grams[k, "", _slot(context + "\x00")] += n
    return pd.DataFrame([(*g, n) for g, n in grams.items()], columns=["ord", "letter", "slot", "n"])


def fit_clean(words: DataFrame) -> CleanModel:
    """The model of the words in ``word`` with their counts ``n``. At most len(ORDERS) x SLOTS numbers, and the letters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield _ngram_rows(zip(b["word"], b["n"].tolist()))

    counted = words.select("word", "n").mapInPandas(run, "ord int, letter string, slot int, n bigint").groupBy("ord", "letter", "slot").agg(F.sum("n").alias("n")).toPandas()
    tables = {}
    for k in ORDERS:
        t = np.zeros(SLOTS, dtype=np.int64)
        part = counted[counted["ord"] == k]
        t[part["slot"].to_numpy(dtype=np.int64)] = part["n"].to_numpy(dtype=np.int64)
        tables[k] = t
    letters = counted[counted["ord"] == 1]
    return CleanModel(tables, dict(zip(letters["letter"], letters["n"].tolist())))


def word_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """Distinct words with a character beyond ASCII and how often they stand in all documents: word, n."""
    words = documents.select(F.explode(F.split(text, SEPARATORS)).alias("word")).filter(F.col("word").rlike(r"[^\x00-\x7f]"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


class Garbling:
    """A fitted model: clean n-grams, the states that occur and the cost of entering each."""

    def __init__(self, model: CleanModel, cost: dict[str, float] | None, active: frozenset[str] | None):
        self.model, self.cost, self.active = model, cost or {}, active
        self._states: States | None = None

    def __getstate__(self):
        return {**self.__dict__, "_states": None}

    def states(self) -> States:
        if self._states is None:
            self._states = States(self.model, self.active)
        return self._states

    def word_label(self, word: str) -> str | None:
        """The state of a word by itself."""
        best, at = 0.0, None
        for s, (_, gain) in self.states().decodings(word).items():
            gain -= self.cost.get(s, first_cost(s))
            if gain > best:
                best, at = gain, s
        return at


def fit(documents: DataFrame, rounds: int = ROUNDS) -> Garbling:
    """Fit on all words of all documents. Words with replacement characters count as garbled from the start."""
    spark = documents.sparkSession
    words = cut(word_counts(documents), "words")
    total = words.agg(F.sum("n")).first()[0] or 0
    used = [words]
    current = Garbling(fit_clean(words.filter(~F.contains("word", F.lit("�")))), None, None)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(current)  # of fixed size: n-gram tables and letters

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = shared.value
            for b in batches:
                yield b.assign(state=[model.word_label(w) or "" for w in b["word"]])

        # decoding is the work, not the few bytes of a word: a number of tasks that isn't lowered for small partitions
        spread = words.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "word")
        labelled = cut(spread.mapInPandas(run, "word string, n bigint, state string"), "labelled")
        counts = {r["state"]: r["n"] for r in labelled.filter("state <> ''").groupBy("state").agg(F.sum("n").alias("n")).collect()}
        # a state that no word is in drops out; the rest cost what their frequency says, within bounds
        cost = {s: min(9.0, max(first_cost(s), -log((n + 0.5) / (total + 1)))) for s, n in counts.items()}
        current = Garbling(fit_clean(labelled.filter("state = ''")), cost, frozenset(counts) | {LOST})
        used.append(labelled)
    for t in used:
        discard(t)
    return current


def _restore(text: str, model: Garbling, known: dict[str, dict[str, tuple[str, float]]]) -> tuple[list[tuple[int, int, str]], str, bool]:
    """Labelled stretches (start, end, state), the restored text, and whether all stretches could be restored.

    ``known``: decodings of words; others are added to it.
    """
    spans = [m.span() for m in re.finditer(WORD, text) if not m.group().isascii()]
    found = []
    for a, b in spans:
        word = text[a:b]
        if word not in known:
            known[word] = model.states().decodings(word)
        found.append(known[word])
    labels = label(found, model.cost)
    out, at, whole, marked = [], 0, True, []
    for (a, b), d, s in zip(spans, found, labels):
        if s is None:
            continue
        marked.append((a, b, s))
        if s == LOST or s not in d:
            whole = False  # what stood there is gone; the stretch is left as it is
            continue
        whole = whole and not s.endswith("dropped")  # the likeliest original, but bytes are gone
        out += [text[at:a], d[s][0]]
        at = b
    return marked, "".join([*out, text[at:]]), whole


def suspects(words: DataFrame, model: Garbling, tasks: int) -> DataFrame:
    """The distinct words in ``word`` that a garbled state explains better than the clean one: word, state, gain, cost."""
    shared = words.sparkSession.sparkContext.broadcast(model)  # of fixed size: n-gram tables and letters

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = shared.value
        for b in batches:
            rows = [(w, s, float(g), float(enter_cost(s, at.cost))) for w in b["word"] for s, (_, g) in at.states().decodings(w).items() if g > 0]
            yield pd.DataFrame(rows, columns=["word", "state", "gain", "cost"])

    # decoding is the work, not the few bytes of a word: a number of tasks that isn't lowered for small partitions
    return words.select("word").repartition(tasks, "word").mapInPandas(run, "word string, state string, gain double, cost double")


def garbled_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", model: Garbling | None = None) -> DataFrame:
    """The documents with a garbled stretch: key, num_words, states, restored_text, fully_restored.

    ``num_words`` are the words labelled, ``states`` their encoding pairs as ``written>read``, sorted, by commas.
    Stretches with replaced bytes stay as they are, those with dropped bytes become their likeliest original; both make
    ``fully_restored`` false. Null, empty and plain ASCII texts are clean. Repeated texts are treated alike. Whole texts
    are read, however long. Rows with one key are each labelled; a null is a key too.

    A state is entered only where the words that it explains better outweigh the cost of entering. Distinct words are
    decoded once to find the documents in which any state's words do; only these go to the labelling.
    """
    plain = documents.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.col("text").rlike(r"[^\x00-\x7f]"))
    fitted = model or fit(plain.select("text"))
    spark = documents.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    decoded = cut(suspects(word_counts(plain), fitted, tasks), "suspects")
    in_text = plain.select("key", F.explode(F.split("text", SEPARATORS)).alias("word")).filter(F.col("word").rlike(r"[^\x00-\x7f]"))
    outweigh = in_text.join(decoded, "word").groupBy("key", "state").agg((F.sum("gain") > F.max("cost") - 1e-6).alias("enough")).filter("enough")
    likely = outweigh.select(F.col("key").alias("__key")).distinct()
    shared = spark.sparkContext.broadcast(fitted)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, known = shared.value, {}
        for b in batches:
            rows = []
            for k, t in zip(b["key"], b["text"]):
                if len(known) > CACHE:
                    known.clear()
                marked, restored, whole = _restore(t, at, known)
                if marked:
                    rows.append((k, len(marked), ",".join(sorted({s for _, _, s in marked})), restored, whole))
            yield pd.DataFrame(rows, columns=["key", "num_words", "states", "restored_text", "fully_restored"])

    marked_texts = plain.join(likely, F.col("key").eqNullSafe(F.col("__key")), "left_semi")
    out = marked_texts.mapInPandas(run, f"key {kind}, num_words int, states string, restored_text string, fully_restored boolean")
    return out.withColumnRenamed("key", key)
