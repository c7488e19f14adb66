"""Abusive, hateful or sexual content: deobfuscation by a noisy channel, then scoring of the restored text."""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvinlake.llm import lexicon, scorer
from kelvinlake.session import spread

#: Hash table of word counts over all documents; its size bounds what reaches the driver and the workers.
VOCABULARY = 1 << 18
#: Share of all words from which a word counts as known.
KNOWN_SHARE = 2.5e-6
#: Share of all words from which a word counts as common.
COMMON_SHARE = 1e-4
#: Costs of the channel, in nats: a stand-in for a letter, a mask, a repeated letter, a separator.
LEET_COST, MASK_COST, REPEAT_COST, SPLIT_COST = 1.0, 1.0, 0.8, 0.3
#: Passages from this score on make a document a case.
THRESHOLD = 0.5
#: What a word of the lists and one the documents know are worth against any other string of letters, in nats.
LISTED_BONUS, KNOWN_BONUS = 4.0, 2.5

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_INVISIBLE = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, 0x180E], "")
_LOOK = str.maketrans(lexicon.LOOKALIKES)
_BROKEN = re.compile("[Â-ô][\u0080-¿Œ-Ÿ–-™ƒˆ˜€]+")
_TAG = re.compile(r"<[^<>]{1,200}>|&(?:nbsp|amp|lt|gt|quot);|\[/?[a-z]{1,8}\]")
_HASHTAG = re.compile(r"#(\w{3,})")
_CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
#: Abbreviations whose full stop ends no sentence.
_ABBREV = frozenset("fig. figs. eq. ref. refs. no. vs. al. approx. ca. dr. prof. abb. bzw.".split())
_WRAP = re.compile(r"[ \t]*\r?\n(?!\s*\n)[ \t]*")
_BLANKS = re.compile(r"[ \t]{2,}|\t")
_PARAGRAPH = re.compile(r"\n\s*\n\s*")
_QUOTE = re.compile(r"\s+(?=>)")
_END = re.compile(r"[.!?][\"')\]]*\s+")
_COMBINING = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]+")
_SPACED = re.compile(r"(?<![^\W_])[^\W_]([ \-._*/]{1,2})[^\W\d_](?:\1[^\W\d_]){1,}(?![^\W_])")
#: Two single letters with the same separator: what letters spread by separators hold.
_SINGLE = re.compile(r"(?<![^\W_])[^\W_]([ \-._*/]{1,2})[^\W\d_]\1[^\W\d_](?![^\W_])|[ \-._*/][^\W\d_]([ \-._*/]{1,2})[^\W\d_]\2")
#: Tokens that such a letter can be where the separator holds a blank.
_MIDDLE = frozenset(t for c in _LETTERS + _LETTERS.upper() for t in (c, *(f"{c}{x}" for x in "-._*/"), *(f"{x}{c}" for x in "-._*/")))
_TOKEN = re.compile(r"[^\s\"“”„«»,;:?()\[\]{}<>/\\]+")
_ELEMENT = "|".join(sorted(lexicon.ELEMENTS, key=len, reverse=True))
_FORMULA = re.compile(rf"(?:(?:{_ELEMENT})(?:[1-9]\d*(?:\.\d+)?|0?\.\d+|[-+]?x)?[-+]?)+$")
_LABEL = re.compile(r"[A-Z]-?\d+[a-z]?|[a-z]-\d+|\d+-[a-z]+|[a-zA-Z]+[-'’][a-zA-Z]+(?:[-'’][a-zA-Z]+)*")
_NUMBER = re.compile(r"[-+]?\d+(?:[.,]\d+)*(?:e[-+]?\d+)?([%a-zA-Z]*)")


def repair(text: str) -> str:
    """Undo UTF-8 that was read as Windows-1252 or Latin-1."""

    def fix(m: re.Match) -> str:
        for code in ("cp1252", "latin-1"):
            try:
                return m.group().encode(code).decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                continue
        return m.group()

    return _BROKEN.sub(fix, text) if ("Ã" in text or "Â" in text or "â" in text) else text


def fold(text: str) -> str:
    """Latin letters without accents, in the case given; look-alikes of other scripts become Latin."""
    if text.isascii() or (text := text.translate(_INVISIBLE)).isascii():
        return text
    text = unicodedata.normalize("NFKD", text.translate(_LOOK)).translate(_LOOK)
    return _COMBINING.sub("", text)


def passages(text: str | None) -> list[str]:
    """The text as folded passages, about one per sentence: markup, hard wraps and hashtags undone."""
    if not text:
        return []
    text = repair(text)
    if "<" in text or "&" in text or "[" in text:
        text = _TAG.sub(" ", text)
    text = fold(text)
    if "#" in text:
        text = _HASHTAG.sub(lambda m: ". " + " ".join(_CAMEL.findall(m.group(1))) + ". ", text)
    if "\n" in text:
        text = _WRAP.sub(" ", text)
    if "  " in text or "\t" in text:
        text = _BLANKS.sub(" ", text)
    out: list[str] = []
    for paragraph in _PARAGRAPH.split(text) if "\n" in text else (text,):
        for part in _QUOTE.split(paragraph) if ">" in paragraph else (paragraph,):
            at = 0
            for m in _END.finditer(part):
                # A full stop after an abbreviation ends nothing.
                if part[m.start()] == "." and part[max(at, m.start() - 8) : m.start() + 1].rsplit(" ", 1)[-1].lstrip("(").lower() in _ABBREV:
                    continue
                if sentence := part[at : m.end()].strip():
                    out.append(sentence)
                at = m.end()
            if sentence := part[at:].strip():
                out.append(sentence)
    return out


# ---- the character language model -----------------------------------------------------------------------------------

_SIZE = 27
_CONTEXTS = _SIZE**3


def _key(gram: str) -> int:
    """A gram over a-z and the boundary as a number to the base 27."""
    k = 0
    for c in gram:
        k = k * _SIZE + (0 if c == " " else ord(c) - 96)
    return k


def corpus_counts(documents: DataFrame) -> DataFrame:
    """Counts over the whole texts of all documents: (kind, key, n), kind 0 character four-grams, kind 1 hashed words.

    The number of rows is bounded by 27**4 + VOCABULARY whatever the input; tasks send partial sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter[str] = Counter()
        grams: Counter[int] = Counter()
        hashed: Counter[int] = Counter()

        def spill() -> None:
            for w, n in words.items():
                hashed[zlib.crc32(w.encode()) % VOCABULARY] += n
                k = 0
                for c in w.encode() + b"`":  # the sign before a stands for the boundary, 0
                    k = (k * _SIZE + c - 96) % _SIZE**4
                    grams[k] += n
            words.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    words.update(re.findall(r"[a-z]+", fold(repair(text)).lower()))
                    if len(words) > 200_000:
                        spill()
        spill()
        keys = [*grams, *hashed]
        yield pa.RecordBatch.from_arrays(
            [pa.array([0] * len(grams) + [1] * len(hashed), pa.int32()), pa.array(keys, pa.int32()), pa.array([*grams.values(), *hashed.values()], pa.int64())], names=["kind", "key", "n"]
        )

    return documents.select("text").mapInArrow(run, "kind int, key int, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


@dataclass
class CharModel:
    """Character four-gram model with backoff, a hashed table of word counts, and a trie of listed words."""

    grams: dict[int, float]
    vocabulary: np.ndarray
    total: int
    words: frozenset[str]
    _memo: dict[str, str] = field(default_factory=dict)
    _tokens: dict[str, str] = field(default_factory=dict)
    _log: np.ndarray | None = None
    _trie: list | None = None

    def __getstate__(self):
        return {**self.__dict__, "_memo": {}, "_tokens": {}, "_log": None, "_trie": None}

    @classmethod
    def fit(cls, counts: DataFrame, listed: list[str], extra: list[str]) -> CharModel:
        """From the counts of the corpus, with words of the lists and examples added so that what is hidden can be restored."""
        grams: Counter[int] = Counter()
        vocabulary = np.zeros(VOCABULARY, dtype=np.int64)
        table = counts.toArrow()  # at most 27**4 + VOCABULARY rows
        for kind, key, n in zip(*(table.column(c).to_pylist() for c in ("kind", "key", "n")), strict=True):
            if kind:
                vocabulary[key] = n
            else:
                grams[key] = n
        total = int(vocabulary.sum())
        boost = max(1.0, 2e-5 * total)
        for w, n in Counter([*listed, *listed, *extra]).items():
            padded = f"   {w} "
            for i in range(len(padded) - 3):
                grams[_key(padded[i : i + 4])] += boost * min(n, 3)
        return cls(dict(grams), vocabulary, total, frozenset(listed) | frozenset(extra))

    def count(self, word: str) -> int:
        """How often a word occurs in the documents, or more where words share a bucket."""
        return int(self.vocabulary[zlib.crc32(word.encode()) % VOCABULARY])

    def known(self, word: str) -> bool:
        return word in self.words or self.frequent(word)

    def frequent(self, word: str) -> bool:
        return self.count(word) >= max(3, KNOWN_SHARE * self.total)

    def common(self, word: str) -> bool:
        """Whether a word is among the most frequent of the documents."""
        return self.count(word) >= max(3, COMMON_SHARE * self.total)

    def log_next(self) -> np.ndarray:
        """log P(c | last three letters) for every context and letter, interpolated with the bigram and unigram."""
        if self._log is None:
            four = np.zeros(_SIZE**4)
            at = np.fromiter(self.grams, dtype=np.int64, count=len(self.grams))
            four[at] = np.fromiter(self.grams.values(), dtype=float, count=len(self.grams))
            four = four.reshape(_CONTEXTS, _SIZE)
            two = four.reshape(_SIZE * _SIZE, _SIZE, _SIZE).sum(axis=0)
            one = two.sum(axis=0) + 1
            p1 = one / one.sum()
            p2 = (two + 2 * p1) / (two.sum(axis=1, keepdims=True) + 2)
            prior = np.tile(p2, (_SIZE * _SIZE, 1))
            self._log = np.log((four + 3 * prior) / (four.sum(axis=1, keepdims=True) + 3))
        return self._log

    def log_word(self, word: str) -> float:
        log, context, out = self.log_next(), 0, 0.0
        for c in word:
            x = ord(c) - 96
            out += log[context, x]
            context = (context * _SIZE + x) % _CONTEXTS
        return float(out + log[context, 0])

    def trie(self) -> list:
        """Nodes [children by letter, letter, word ending here, cost of it]; node 0 is the root."""
        if self._trie is None:
            nodes: list = [[{}, "", None, 0.0]]
            for w in sorted(self.words):
                at = 0
                for c in w:
                    if c not in nodes[at][0]:
                        nodes[at][0][c] = len(nodes)
                        nodes.append([{}, c, None, 0.0])
                    at = nodes[at][0][c]
                nodes[at][2], nodes[at][3] = w, self.log_word(w)
            self._trie = nodes
        return self._trie

    @staticmethod
    def lattice(token: str) -> list[tuple[list[tuple[str, float]], float | None]]:
        """Per character, the letters it may stand for with their costs, and the cost of leaving it out, if it may be.

        A mask is a separator as well where single letters alternate with signs.
        """
        spread_out = len(token) > 2 and not any(x.isalnum() for x in token[1::2]) and all(x.isalnum() for x in token[::2])
        out = []
        for c in token:
            if c in lexicon.MASKS:
                options = [(x, MASK_COST) for x in _LETTERS]
            elif c in _LETTERS:
                options = [(c, 0.0)]
            else:
                options = [(x, LEET_COST) for x in lexicon.LEET.get(c, "")]
            drop = None
            if c in "-._ '/" or (c == "*" and spread_out) or not options:
                drop = SPLIT_COST + (1.5 if options else 0.0)
            out.append((options, drop))
        return out

    def decode(self, token: str) -> str:
        """The likeliest word behind a token, by Viterbi over the lattice of what its characters may stand for.

        A letter stands for itself or, after the same letter, for a repetition; digits and signs for the letters they
        resemble; masks for any letter; separators for nothing. Both searches are exact, of tokens of any length: one
        over the trie of listed words, one over all strings of letters under the character model. Listed words are
        preferred, then words the documents know.
        """
        token = token.lower()
        held = self._memo.get(token)
        if held is not None:
            return held
        lattice = self.lattice(token)
        ends = [(score + LISTED_BONUS, word) for score, word in self._listed(lattice)]
        score, word = self._free(lattice)
        if word:
            ends.append((score + (LISTED_BONUS if word in self.words else KNOWN_BONUS if self.known(word) else 0.0), word))
        best = max(ends)[1] if ends else token
        # A string that no one knows hides nothing, so a long listed word that fits as well is meant.
        if not self.known(best) and (listed := [e for e in ends[:-1] if len(e[1]) > 4]):
            best = max(listed)[1]
        if len(self._memo) > 50_000:
            self._memo.clear()
        self._memo[token] = best
        return best

    def _listed(self, lattice: list) -> list[tuple[float, str]]:
        nodes = self.trie()
        states = {0: 0.0}
        for options, drop in lattice:
            nxt: dict[int, float] = {}
            for at, score in states.items():
                children, letter = nodes[at][0], nodes[at][1]
                for x, cost in options:
                    to = children.get(x)
                    if to is not None and nxt.get(to, -math.inf) < score - cost:
                        nxt[to] = score - cost
                    if x == letter and nxt.get(at, -math.inf) < score - cost - REPEAT_COST:
                        nxt[at] = score - cost - REPEAT_COST
                if drop is not None and nxt.get(at, -math.inf) < score - drop:
                    nxt[at] = score - drop
            states = nxt
            if not states:
                break
        return [(score + nodes[at][3], nodes[at][2]) for at, score in states.items() if nodes[at][2]]

    def _free(self, lattice: list) -> tuple[float, str]:
        """Best string of letters: states are the last three letters, with all of them kept; back pointers give the path."""
        log = self.log_next()
        states: dict[int, float] | np.ndarray = {0: 0.0}
        back: list = []
        for options, drop in lattice:
            if isinstance(states, dict) and len(options) > 2:
                dense = np.full(_CONTEXTS, -np.inf)
                for at, score in states.items():
                    dense[at] = score
                states = dense
            if isinstance(states, dict):
                nxt: dict[int, float] = {}
                came: dict[int, tuple[int, int]] = {}
                for at, score in states.items():
                    moves = [((at * _SIZE + ord(x) - 96) % _CONTEXTS, score - cost + log[at, ord(x) - 96], ord(x) - 96) for x, cost in options]
                    moves += [(at, score - cost - REPEAT_COST, 0) for x, cost in options if at % _SIZE == ord(x) - 96]
                    if drop is not None:
                        moves.append((at, score - drop, 0))
                    for to, s, x in moves:
                        if s > nxt.get(to, -math.inf):
                            nxt[to], came[to] = s, (at, x)
                states = nxt
            else:
                new = np.full(_CONTEXTS, -np.inf)
                source = np.arange(_CONTEXTS, dtype=np.int32)
                letter = np.zeros(_CONTEXTS, dtype=np.int8)
                if drop is not None:
                    new = states - drop
                for x, cost in options:
                    x = ord(x) - 96
                    if np.isfinite(states[x::_SIZE]).any():
                        stay = states[x::_SIZE] - cost - REPEAT_COST
                        better = stay > new[x::_SIZE]
                        new[x::_SIZE][better] = stay[better]
                    step = (states - cost + log[:, x]).reshape(_SIZE, _SIZE * _SIZE)
                    first = step.argmax(axis=0)
                    value = step[first, np.arange(_SIZE * _SIZE)]
                    to = np.arange(_SIZE * _SIZE) * _SIZE + x
                    better = value > new[to]
                    new[to[better]] = value[better]
                    source[to[better]] = (first * _SIZE * _SIZE + np.arange(_SIZE * _SIZE))[better]
                    letter[to[better]] = x
                states, came = new, (source, letter)
            back.append(came)
        if isinstance(states, dict):
            ends = {at: s + log[at, 0] for at, s in states.items() if at}
            if not ends:
                return -math.inf, ""
            at = max(ends, key=ends.get)
            score = ends[at]
        else:
            final = states + log[:, 0]
            final[0] = -np.inf
            at = int(final.argmax())
            score = float(final[at])
            if not np.isfinite(score):
                return -math.inf, ""
        out = []
        for came in reversed(back):
            at, x = came[at] if isinstance(came, dict) else (int(came[0][at]), int(came[1][at]))
            if x:
                out.append(chr(96 + x))
        return float(score), "".join(reversed(out))

    def restore(self, passage: str) -> str:
        """The passage in lower case with its disguised tokens decoded, and a left-out letter of a listed word put back; ordinary words stay as they are."""
        memo = self._tokens

        def token(m: re.Match) -> str:
            whole = m.group()
            held = memo.get(whole)
            if held is None:
                if len(memo) > 500_000:
                    memo.clear()
                held = memo[whole] = self._token(whole)
            return held

        if _SINGLE.search(passage):
            passage = _SPACED.sub(lambda m: self._joined(m.group()), passage)
        return _TOKEN.sub(token, passage)

    def _joined(self, spaced: str) -> str:
        """Letters spread by separators as one word; a leading article stays apart if the rest is a word of the lists."""
        if spaced[:2].lower() in ("a ", "i ") and (rest := self.decode(spaced[2:])) in self.words:
            return f"{spaced[0]} {rest}"
        return self.decode(spaced)

    def _token(self, whole: str) -> str:
        raw = whole.strip(".!'`~^-")
        if not raw or raw.isdigit():
            return whole.lower()
        low = raw.lower()
        if raw.isascii() and raw.isalpha():
            if (full := _short().get(low)) is not None and not self.known(low):
                return whole.lower().replace(low, full)
            if len(low) > 3 and re.search(r"(.)\1", low) and not self.known(low):
                word = self.decode(low)
                return whole.lower().replace(low, word) if self.known(word) else whole.lower()
            return whole.lower()
        if not re.search("[a-zA-Z]", raw) or _FORMULA.match(raw) or _LABEL.fullmatch(raw) or ((m := _NUMBER.fullmatch(raw)) and (not m.group(1) or m.group(1) in lexicon.UNITS)):
            return whole.lower()
        tail = whole[len(whole.rstrip(".!'`~^-")) :]
        full = whole[: len(whole) - len(tail)] if "!" in whole[:-1] else raw
        word = self.decode(full)
        return f"{word}{'!' if '!' in tail else ''}" if self.known(word) else low


def _short() -> dict[str, str]:
    """Listed insults with one letter left out."""
    if not _SHORT:
        for name, least in (("insult", 5), ("weak", 6), ("scorn", 6), ("swear", 6), ("sexword", 6), ("dehuman", 7)):
            for w in lexicon.CLASSES[name]["en"].split():
                if w.isalpha() and len(w) >= least:
                    _SHORT.update({w[:i] + w[i + 1 :]: w for i in range(len(w))})
        for w in _SHORT.keys() & set(scorer.listed_words()):
            del _SHORT[w]
    return _SHORT


_SHORT: dict[str, str] = {}


# ---- scoring --------------------------------------------------------------------------------------------------------


@dataclass
class Moderator:
    chars: CharModel
    scorer: scorer.Scorer
    _quiet: set[str] = field(default_factory=set)
    _base: tuple[float, str] | None = None

    def __getstate__(self):
        return {**self.__dict__, "_quiet": set()}

    @classmethod
    def fit(cls, documents: DataFrame, examples: DataFrame) -> Moderator:
        """Train on counts over all documents, on the labelled examples (a fixed table) and on the frames."""
        rows = [(r["snippet"], r["label"]) for r in examples.filter(F.col("snippet").isNotNull() & F.col("label").isin(*scorer.CATEGORIES)).orderBy("example_id").collect()]
        plain = [w for t, label in rows if label != "none" for p in passages(t) for w in re.findall(r"[a-z]+", p.lower()) if len(w) > 2]
        chars = CharModel.fit(corpus_counts(documents), scorer.listed_words(), plain)
        known = [(chars.restore(p), label) for t, label in rows for p in passages(t)]
        return cls(chars, scorer.Scorer.fit(known, chars.common, chars.frequent))

    def quiet(self, passage: str) -> bool:
        """Whether no token of a passage is disguised or evidence, so that its score is that of no evidence; quiet tokens are remembered."""
        quiet = self._quiet
        tokens = passage.split()
        if not quiet.issuperset(tokens):
            for t in tokens:
                if t not in quiet:
                    if self.chars.restore(t) != t.lower() or any(map(self.scorer.speaks, scorer.words_of(t.lower()))):
                        return False
                    if len(quiet) > 500_000:
                        quiet.clear()
                    quiet.add(t)
        # Letters spread over several tokens have one between two separators.
        return (passage.isascii() and _MIDDLE.isdisjoint(tokens)) or not _SINGLE.search(passage)

    def judge(self, passage: str) -> tuple[float, str]:
        """Score and category of one passage: the greater of the restored and the plain text."""
        if self.quiet(passage):
            if self._base is None:
                self._base = self.scorer.score("")
            return self._base
        restored, plain = self.chars.restore(passage), passage.lower()
        best = self.scorer.score(restored)
        return best if restored == plain else max(best, self.scorer.score(plain))


SCORE_SCHEMA = "doc_id long, source string, score double, category string, n_passages int, n_flagged int, worst string"


def score_documents(documents: DataFrame, moderator: Moderator, threshold: float = THRESHOLD) -> DataFrame:
    """Score of every document: that of its worst passage, with category, counts and the passage itself.

    Every passage of the whole text is restored and scored, also inside quotations. Documents whose worst score is
    below the threshold have category none and no worst passage; null and blank texts score 0. A document delivered
    twice is scored twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                score, kind, flagged, worst = 0.0, "none", 0, None
                parts = passages(text)
                for p in parts:
                    s, k = moderator.judge(p)
                    flagged += s >= threshold
                    if s > score:
                        score, kind, worst = s, k, p
                hit = score >= threshold
                rows.append((score, kind if hit else "none", len(parts), flagged, worst if hit else None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            types = [pa.float64(), pa.string(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", "source", "score", "category", "n_passages", "n_flagged", "worst"]
            )

    return spread(documents.select(F.col("doc_id").cast("long"), "source", "text")).mapInArrow(run, SCORE_SCHEMA)


def rates(scores: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per source: documents, cases by category, and the rate of cases."""
    bad = F.col("score") >= threshold
    return scores.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(bad).alias("n_cases"),
        *(F.count_if(bad & (F.col("category") == c)).alias(f"n_{c}") for c in ("abusive", "hateful", "sexual")),
        F.avg(bad.cast("double")).alias("case_rate"),
        F.avg("score").alias("mean_score"),
    )
