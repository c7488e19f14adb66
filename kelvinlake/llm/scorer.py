"""A trained scorer of restored passages: classes of words, how they stand to each other, and learned words."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import numpy as np

from kelvinlake.llm import lexicon, seeds

CATEGORIES = ("none", "abusive", "hateful", "sexual")
#: Words at most this far apart stand near each other.
NEAR = 5
#: Weight decay of the fit, and the scale of learned words against classes.
DECAY, WORD_SCALE = 3e-4, 1.0
#: Weight of the training row that stands for passages without evidence, of frames, and of labelled rows.
QUIET_WEIGHT, FRAME_WEIGHT, LABEL_WEIGHT = 400.0, 1.0, 1.0

_WORD = re.compile(r"[a-z]+(?:['-][a-z]+)*")
_CLITICS = frozenset("moi toi la le les tu vous je il elle ils moi-meme".split())
_FUNCTION = {lang: frozenset(words) for lang, words in lexicon.FUNCTION_WORDS.items()}
_TRIGGERS = frozenset(lexicon.TRIGGERS)
#: Classes of words that have plain uses as well: where the documents use a word often, its class counts apart and triggers nothing.
_PLAIN = _TRIGGERS - {"insult", "sexword", "swear", "group", "groupadj"}


def _tables() -> tuple[dict[str, dict[str, frozenset[str]]], dict[str, dict[str, frozenset[str]]]]:
    exact: dict[str, dict[str, set[str]]] = {lang: {} for lang in lexicon.FUNCTION_WORDS}
    stems: dict[str, dict[str, set[str]]] = {lang: {} for lang in lexicon.FUNCTION_WORDS}
    for name, by_lang in lexicon.CLASSES.items():
        for lang, words in by_lang.items():
            for w in words.split():
                (stems if w.endswith("*") else exact)[lang].setdefault(w.rstrip("*"), set()).add(name)
    return tuple({lang: {w: frozenset(c) for w, c in t.items()} for lang, t in table.items()} for table in (exact, stems))


_EXACT, _STEMS = _tables()
_LONGEST_STEM = max(len(w) for t in _STEMS.values() for w in t)
#: Insults of other languages that are understood within English text as well.
_LOANS = {w: c for lang in ("de", "fr", "es") for w, c in _EXACT[lang].items() if "insult" in c and len(w) > 5 and w not in _EXACT["en"]}
#: Classes of English words that are understood within text of other languages as well.
_ABROAD = frozenset(("insult", "sexword", "swear"))


#: Endings that stand for those of a stem when a disguised word is restored.
_ENDINGS = {"en": ("ed", "ing", "ion"), "de": ("e", "en", "er"), "fr": ("e", "s", "er"), "es": ("o", "a", "os", "as")}


def listed_words() -> list[str]:
    """Every word or stem of a class that can trigger, and stems with common endings."""
    found = {w + e for t in (_EXACT, _STEMS) for lang, by in t.items() for w, c in by.items() if c & _TRIGGERS for e in ("", *(_ENDINGS[lang] if t is _STEMS and len(w) > 4 else ()))}
    return sorted(w for w in found if len(w) > 2 and w.isascii() and w.isalpha())


def classes_of(word: str, lang: str) -> frozenset[str]:
    """Classes of a word in a language; a plural s is allowed for, stems stand for any ending."""
    exact = _EXACT[lang]
    found = exact.get(word) or (exact.get(word[:-1]) if word.endswith("s") and len(word) > 3 else None) or (exact.get(word[:-2]) if word.endswith(("es", "'s")) and len(word) > 4 else None) or frozenset()
    stems = _STEMS[lang]
    for n in range(2, min(len(word), _LONGEST_STEM) + 1):
        if (c := stems.get(word[:n])) is not None:
            found |= c
    if lang == "en":
        return found | _LOANS.get(word, frozenset())
    if word in _FUNCTION[lang]:
        return found
    return found | (classes_of(word, "en") & _ABROAD)


def words_of(restored: str) -> list[str]:
    """Words of a passage; a compound with a hyphen counts as its last part, as that says what the whole is."""
    out = []
    for w in _WORD.findall(restored):
        if "-" in w:
            parts = w.split("-")
            if parts[-1] in _CLITICS:
                out.extend(parts)
            else:
                out.append(parts[-1] if classes_of(parts[-1], "en") & {"insult"} else w)
        else:
            out.append(w)
    return out


def languages(words: list[str]) -> list[str]:
    """The languages whose function words are most frequent; all of them where none occurs."""
    hits = {lang: sum(w in known for w in words) for lang, known in _FUNCTION.items()}
    best = max(hits.values())
    return [lang for lang, n in hits.items() if n == best]


@dataclass
class Scorer:
    """Softmax regression over categories. ``common`` tells whether a word is frequent in the documents at large."""

    columns: dict[tuple, int]
    weights: np.ndarray
    bias: np.ndarray
    learned: frozenset[str]
    common: Callable[[str], bool]
    _classes: dict[tuple[str, str], frozenset[str]] = field(default_factory=dict)
    _trigger: dict[str, bool] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "_classes": {}, "_trigger": {}}

    def classes(self, word: str, langs: Iterable[str]) -> frozenset[str]:
        out: frozenset[str] = frozenset()
        for lang in langs:
            held = self._classes.get((word, lang))
            if held is None:
                if len(self._classes) > 500_000:
                    self._classes.clear()
                held = self._classes[word, lang] = classes_of(word, lang)
            out = out | held if out else held
        return out

    def _technical(self, word: str) -> bool:
        return len(word) > 3 and self.common(word)

    def _within(self, word: str, following: str, langs: Iterable[str]) -> frozenset[str]:
        """Classes of a word where it stands. Frequent words of the documents carry their classes apart, marked as such."""
        found = self.classes(word, langs)
        if found and self.common(word):
            found = frozenset(c + "~" if c in _PLAIN else c for c in found)
        if "groupadj" in found:
            found = found - {"groupadj"} | ({"group"} if following in lexicon.PEOPLE else set())
        return found

    def speaks(self, word: str) -> bool:
        """Whether a word can be evidence: it is of a triggering class in some language, or learned from the examples.

        A passage without such a word has no features, so its score is that of the bias alone.
        """
        held = self._trigger.get(word)
        if held is None:
            if len(self._trigger) > 500_000:
                self._trigger.clear()
            held = self._trigger[word] = word in self.learned or bool((c := self.classes(word, _EXACT) & _TRIGGERS) and (c - _PLAIN or not self.common(word)))
        return held

    def features(self, restored: str) -> set[tuple]:
        words = words_of(restored)
        if not any(map(self.speaks, words)):
            return set()
        langs = languages(words)
        hits = [(i, c) for i, w in enumerate(words) if (c := self._within(w, words[i + 1] if i + 1 < len(words) else "", langs))]
        out: set[tuple] = set()
        present: set[str] = set()
        for at, (i, cs) in enumerate(hits):
            for c in cs:
                if c in _TRIGGERS:
                    out.add(("c", c) if c not in present else ("cc", c))
                    if i + 1 < len(words) and self._technical(words[i + 1]):
                        out.add(("t", c))
                    if i and self._technical(words[i - 1]):
                        out.add(("b", c))
                    if i == 0:
                        out.add(("f", c))
                    if i == len(words) - 1:
                        out.add(("l", c))
            present |= cs
            for j, ds in hits[at + 1 :]:
                if j - i > NEAR:
                    break
                for c in cs:
                    for d in ds:
                        if c in _TRIGGERS or d in _TRIGGERS:
                            out.add(("n", c, d))
                            if j == i + 1:
                                out.add(("1", c, d))
        for c in present & _TRIGGERS:
            for d in present:
                if c != d and (d not in _TRIGGERS or c < d):
                    out.add(("p", c, d))
        before = ""
        for w in words:
            if w in self.learned:
                out.add(("w", w))
                out.add(("w", before, w))
            elif before in self.learned:
                out.add(("w", before, w))
            before = w
        text = " ".join(words)
        if any(p in text for p in lexicon.PHRASES) and any(re.search(rf"\b{p}\b(?! the\b| a\b)", text) for p in lexicon.PHRASES):
            out.add(("phrase",))
        return out

    def probabilities(self, restored: str) -> np.ndarray:
        z = self.bias.copy()
        for f in self.features(restored):
            at = self.columns.get(f)
            if at is not None:
                z += self.weights[at]
        z = np.exp(z - z.max())
        return z / z.sum()

    def score(self, restored: str) -> tuple[float, str]:
        """Probability that a passage is a case, and its likeliest category."""
        p = self.probabilities(restored)
        return 1.0 - float(p[0]), CATEGORIES[1 + int(p[1:].argmax())]

    @classmethod
    def fit(cls, examples: list[tuple[str, str]], common: Callable[[str], bool], known: Callable[[str], bool], frames: list[tuple[str, str]] | None = None) -> Scorer:
        """From labelled passages (restored text, category) and the frames of :mod:`kelvinlake.llm.seeds`.

        Learned words are those of labelled cases that the documents at large do not know. Labelled rows that the first
        fit finds very unlikely count as mislabelled and are left out of the second.
        """
        frames = seeds.sentences() if frames is None else frames
        learned = frozenset(w for t, label in examples if label != "none" for w in words_of(t) if len(w) > 2 and not known(w) and not common(w))
        blank = cls({}, np.zeros((0, len(CATEGORIES))), np.zeros(len(CATEGORIES)), learned, common)
        rows = [*((t, c, LABEL_WEIGHT) for t, c in examples), *((t, c, FRAME_WEIGHT) for t, c in frames)]
        found = [blank.features(t) for t, _, _ in rows]
        columns: dict[tuple, int] = {}
        for f in found:
            for name in sorted(f):
                columns.setdefault(name, len(columns))
        x = np.zeros((len(rows) + 1, len(columns)), dtype=np.float32)
        scale = np.array([WORD_SCALE if name[0] == "w" else 1.0 for name in columns], dtype=np.float32)
        for i, f in enumerate(found):
            at = [columns[name] for name in f]
            x[i, at] = scale[at]
        y = np.array([CATEGORIES.index(c) for _, c, _ in rows] + [0])
        weight = np.array([w for _, _, w in rows] + [QUIET_WEIGHT], dtype=np.float32)
        w, b = _softmax_fit(x, y, weight)
        if examples:
            p = _softmax(x @ w + b)[np.arange(len(y)), y][: len(examples)]
            weight[: len(examples)] *= p > 0.1
            w, b = _softmax_fit(x, y, weight)
        return cls(columns, w * scale[:, None], b, learned, common)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _softmax_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression with weight decay, by full-batch Adam."""
    k = len(CATEGORIES)
    target = np.eye(k, dtype=np.float32)[y]
    share = (weight / max(weight.sum(), 1e-9))[:, None]
    w, b = np.zeros((x.shape[1], k), dtype=np.float32), np.zeros(k, dtype=np.float32)
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    xt = np.ascontiguousarray(x.T)
    for step in range(1, rounds + 1):
        g = share * (_softmax(x @ w + b) - target)
        gw, gb = xt @ g + DECAY * w, g.sum(axis=0)
        m, v, mb, vb = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        rate = 0.1 * math.sqrt(1 - 0.99**step) / (1 - 0.9**step) * (1 - step / (rounds + 1))
        w, b = w - rate * m / (np.sqrt(v) + 1e-6), b - rate * mb / (np.sqrt(vb) + 1e-6)
    return w.astype(np.float64), b.astype(np.float64)
