"""Toxicity by a weighted finite-state pattern grammar.

Words become roles (insult, threat, target, negation, reported speech). A look-ahead
reads a clause from its end and marks the insults and threats that a target follows.
Five small transducers then read it from its start, each rewriting the roles: reported
speech, negation and targets mark what follows, an insult is targeted by a target on
either side, a threat only by one behind it. Their composition is one machine that turns
a clause into the patterns it matches ("targeted insult", "reported threat", ...), and a
document's score is a logistic function of the weights of its matched clauses. Patterns
that no labelled text shows have the weights of PRIOR.

Insult words and word stems, and the weight of every pattern, are learned from a
bounded number of labelled rows outside the held-out fold; nothing but the text is
read when scoring. Every text is searched whole, in the task that reads it.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.learning import HELD_OUT, Logistic, fold, labelled_sample, sigmoid

MOST_LABELLED = 8_000      # labelled rows that are learned from
STEMS = (4, 5, 6)
LEAST_COUNT, LEAST_ODDS = 3, 4.0   # toxic texts that an entry is in, whatever the size of the sample; log-odds
THRESHOLD = 0.7

#: Fixed word lists of the grammar's closed classes (English, German, French, Spanish).
TARGETS = ("you your yours yourself he she him her they them these those everyone people du dich dir ihr euch sie er man "
           "tu toi te vous il elle ils elles eux ustedes usted ti ellos ellas él ella nosotros").split()
NEGATIONS = "not no never neither nor none nobody cannot don't isn't aren't nicht kein keine keinen nie niemals pas jamais aucun aucune nunca jamás ningún".split()
REPORTS = ("said says say wrote writes quoted quotes quote called calls reported alleged claimed sagte sagt schrieb schreibt nannte "
           "dit disait écrit écrivait appelé dijo dice escribió llamó").split()
#: Verbs of threats by language, the endings that their stems take, and forms that no rule gives.
THREAT_VERBS = {
    "en": "kill murder hurt destroy shoot stab beat strangle burn crush".split(),
    "de": "töten umbringen schlagen erschlagen erschießen vernichten".split(),
    "fr": "tuer frapper assassiner brûler étrangler".split(),
    "es": "matar golpear quemar asesinar apuñalar".split(),
}
ENDINGS = {
    "de": (2, "en e est et st t ete eten te ten test tet end".split()),
    "fr": (2, "er e es ons ez ent é ée és ées ant ais ait aient ai as a ont erai eras era erons erez eront".split()),
    "es": (2, "ar o as a amos áis an é ó aste aron ando ado aré arás ará aremos arán aba".split()),
}
IRREGULAR = ("shot beaten schlägst schlägt schlug erschlägt erschlug erschossen erschoss umgebracht umzubringen "
             "détruire détruis détruit détruisons détruisez détruisent détruirai détruira destruir destruyo destruyes destruye "
             "destruyen destruyó destruiré destruirá destruido").split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER = "insult", "threat", "target", "negation", "report", "other"
ROLES = (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER)


def inflected(verb: str, language: str) -> set[str]:
    """A regular verb with the endings of its person, tense and participle."""
    if language != "en":
        cut, endings = ENDINGS[language]
        stem = verb[:-cut]
        return {stem + e for e in endings} | ({"ge" + stem + e for e in ("t", "et", "en")} if language == "de" else set())
    vowels = "aeiou"
    short = verb[-1] not in vowels + "wxy" and verb[-2] in vowels and verb[-3] not in vowels
    stem = verb[:-1] if verb.endswith("e") else verb + verb[-1] if short else verb
    return {verb, verb + ("es" if verb.endswith(("s", "sh", "ch", "x")) else "s"), stem + "ed", stem + "ing"}


THREATS = frozenset(IRREGULAR).union(*(inflected(v, language) for language, verbs in THREAT_VERBS.items() for v in verbs))


class Transducer:
    """A deterministic transducer: step(state, symbol) -> (state, symbol); symbols are (role, flags)."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def then(self, other: Transducer) -> Transducer:
        """Composition: what this one writes, the other reads."""
        def step(state, symbol):
            mine, written = self.step(state[0], symbol)
            theirs, out = other.step(state[1], written)
            return (mine, theirs), out
        return Transducer((self.start, other.start), step)

    def table(self, flags: frozenset | None = None) -> tuple[dict, list]:
        """All reachable (state number, role) -> (state number, written symbol), and the states.

        With ``flags`` the keys are (state number, role, whether the word read has these flags).
        """
        states, arcs, todo = {self.start: 0}, {}, [self.start]
        while todo:
            state = todo.pop()
            for role, marked in product(ROLES, (False, True) if flags else (False,)):
                to, out = self.step(state, (role, flags if marked else frozenset()))
                if to not in states:
                    states[to] = len(states)
                    todo.append(to)
                arcs[(states[state], role, marked) if flags else (states[state], role)] = (states[to], out)
        return arcs, list(states)


def marks_after(role: str, flag: str, reach: int) -> Transducer:
    """Insults and threats at most ``reach`` words behind a word of ``role`` get ``flag``."""
    def step(left, symbol):
        kind, flags = symbol
        if kind == role:
            return reach, symbol
        if kind in (INSULT, THREAT) and left > 0:
            return left - 1, (kind, flags | {flag})
        return max(0, left - 1), symbol
    return Transducer(0, step)


def grammar() -> Transducer:
    """reported speech, then negation, then target: each marks what the next reads."""
    return marks_after(REPORT, "reported", 8).then(marks_after(NEGATION, "negated", 3)).then(marks_after(TARGET, "targeted", 4))


FOLLOWED = frozenset({"followed"})


def look_ahead() -> Transducer:
    """Read from the end of a clause: insults and threats with a target at most 4 words behind them."""
    return marks_after(TARGET, "followed", 4)


def insults() -> Transducer:
    """An insult is targeted by a target before it or behind it."""
    def step(state, symbol):
        kind, flags = symbol
        if kind != INSULT:
            return state, symbol
        return state, (kind, flags - FOLLOWED | ({"targeted"} if flags & FOLLOWED else set()))
    return Transducer(0, step)


def threats() -> Transducer:
    """A threat is targeted only by a target behind it; one before it is who acts."""
    def step(state, symbol):
        kind, flags = symbol
        if kind != THREAT:
            return state, symbol
        return state, (kind, flags - FOLLOWED - {"targeted"} | ({"targeted"} if flags & FOLLOWED else set()))
    return Transducer(0, step)


PATTERNS = [(kind, frozenset(f for f, on in zip(("reported", "negated", "targeted"), flags, strict=True) if on))
            for kind in (INSULT, THREAT) for flags in product((False, True), repeat=3)]


#: Weights of the patterns that the labelled sample does not show: 4 if somebody is targeted, 1 if nobody is,
#: 0 where the words are negated or reported. A fitted weight always replaces them.
PRIOR = np.array([0.0 if flags & {"reported", "negated"} else 4.0 if "targeted" in flags else 1.0 for _, flags in PATTERNS])


@functools.lru_cache(maxsize=1)
def whole_machine() -> tuple[dict, dict]:
    """Arcs of the look-ahead (state, role) -> (state, followed), and of all five (state, role, followed) -> (state, pattern)."""
    number = {p: i for i, p in enumerate(PATTERNS)}
    ahead = {k: (to, bool(out[1])) for k, (to, out) in look_ahead().table()[0].items()}
    five = grammar().then(insults()).then(threats())
    return ahead, {k: (to, number.get(out)) for k, (to, out) in five.table(FOLLOWED)[0].items()}


def plain(text: str) -> str:
    """Lower case, typographic apostrophes as plain ones."""
    return text.lower().replace("’", "'")


ELIDED = re.compile(r"(?:[cdjlmnst]|qu)'(?=\w)")


def words_of(text: str) -> list[str]:
    """Words in order; an elided article or pronoun (l'idiot, qu'il) is not part of its word."""
    found = re.findall(r"[^\W_]+(?:'[^\W_]+)?", plain(text))
    return [w[m.end():] if (m := ELIDED.match(w)) else w for w in found]


def entries_of(word: str) -> list[str]:
    """Lexicon entries that a word matches: itself, then its stems, longest first ("abcd*")."""
    return [word, *[word[:n] + "*" for n in sorted(STEMS, reverse=True) if len(word) >= n]]


class Scanner:
    """Finds the clauses with an insult or threat word and runs the machine over them."""

    def __init__(self, lexicon: dict[str, float]):
        import ahocorasick
        self.lexicon = lexicon
        self.closed = ({w: TARGET for w in TARGETS} | {w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTS}
                       | {w: THREAT for w in THREATS})
        self.finder = ahocorasick.Automaton()
        for entry in [*lexicon, *THREATS]:
            self.finder.add_word(entry.rstrip("*"), len(entry.rstrip("*")))
        if len(self.finder):
            self.finder.make_automaton()

    def insult(self, word: str) -> float:
        return max((self.lexicon.get(e, 0.0) for e in entries_of(word)), default=0.0)

    def clauses(self, text: str) -> list[str]:
        """Clauses (between marks of punctuation or line ends) that hold a word starting with an entry."""
        out, end = [], -1
        if not len(self.finder):
            return out
        for at, length in self.finder.iter(text):
            begin = at - length + 1
            if begin < end or begin > 0 and text[begin - 1].isalnum():
                continue
            start = max(text.rfind(c, 0, begin) for c in ".!?;\n") + 1
            end = min((p for p in (text.find(c, begin) for c in ".!?;\n") if p >= 0), default=len(text))
            out.append(text[start:end])
        return out

    def features(self, text: str | None) -> np.ndarray:
        """Per pattern the logarithm of 1 + the weights of its matches in the whole text."""
        total = np.zeros(len(PATTERNS))
        ahead, arcs = whole_machine()
        for clause in self.clauses(plain(text or "")):
            weights = [(word, self.insult(word)) for word in words_of(clause)]
            roles = [INSULT if weight > 0 else self.closed.get(word, OTHER) for word, weight in weights]
            state, followed = 0, []
            for role in reversed(roles):
                state, mark = ahead[state, role]
                followed.append(mark)
            state = 0
            for role, mark, (_, weight) in zip(roles, reversed(followed), weights, strict=True):
                state, pattern = arcs[state, role, mark]
                if pattern is not None:
                    total[pattern] += weight if role == INSULT else 1.0
        return np.log1p(total)


class Model:
    def __init__(self, lexicon: dict[str, float], fit: Logistic | None, prior: np.ndarray | None = None):
        self.lexicon, self.fit = lexicon, fit
        self.prior = np.zeros(len(PATTERNS)) if prior is None else prior

    @functools.cached_property
    def scanner(self) -> Scanner:
        return Scanner(self.lexicon)

    def __getstate__(self):
        return {"lexicon": self.lexicon, "fit": self.fit, "prior": self.prior}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.fit is None:
            return np.zeros(len(texts))
        x = np.array([self.scanner.features(t) for t in texts]).reshape(len(texts), len(PATTERNS))
        return sigmoid(self.fit.logit(x) + x @ self.prior)


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Words and stems far likelier in toxic texts: entry -> log-odds (as many as the bounded sample shows)."""
    def count(batches):
        seen, total = Counter(), Counter()
        for batch in batches:
            for text, y in zip(batch["text"].to_pylist(), batch["y"].to_pylist(), strict=True):
                total[y] += 1
                seen.update({(e, y) for w in set(words_of(text or "")) if len(w) >= 3 for e in entries_of(w)})
        rows = [(e, y, n) for (e, y), n in seen.items()] + [("", y, n) for y, n in total.items()]
        entry, y, n = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_pydict({"entry": pa.array(entry, pa.string()), "y": pa.array(y, pa.int32()), "n": pa.array(n, pa.int64())})

    counts = (sample.select("text", "y").distinct().mapInArrow(count, "entry string, y int, n long")
              .groupBy("entry").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("t"),
                                    F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("c")))
    counts = counts.persist()
    whole = counts.where("entry = ''").first()
    if whole is None or not whole["t"] or not whole["c"]:
        counts.unpersist()
        return {}
    odds = F.log((F.col("t") + 0.5) / (whole["t"] + 1.0)) - F.log((F.col("c") + 0.5) / (whole["c"] + 1.0))
    rows = (counts.where((F.col("entry") != "") & (F.col("t") >= LEAST_COUNT)).withColumn("odds", odds)
            .where(F.col("odds") > LEAST_ODDS).orderBy(F.desc("odds"), "entry").collect())
    counts.unpersist()
    return {r["entry"]: float(r["odds"]) for r in rows}


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Lexicon and pattern weights from at most ``most`` labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, "toxic", most, ["text"]).select("text", "y").distinct().persist()
    lexicon = learn_lexicon(sample)
    unfitted = Model(lexicon, None)

    def features(batches):
        for batch in batches:
            x = [unfitted.scanner.features(t).tolist() for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"x": pa.array(x, pa.list_(pa.float64())), "y": batch["y"]})

    rows = sample.mapInArrow(features, "x array<double>, y int").groupBy("x", "y").count().collect()
    sample.unpersist()
    if len({r["y"] for r in rows}) < 2:
        return Model(lexicon, None)
    x, y, n = (np.array([r[c] for r in rows], float) for c in ("x", "y", "count"))
    return Model(lexicon, Logistic(0.1).fit(x, y, n), np.where((x == 0).all(axis=0), PRIOR, 0.0))


def score(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from THRESHOLD on).

    Null and empty texts match no clause and get the score of such texts; very long
    texts are searched whole; repeated rows score alike; a null id is in fold 0;
    without labelled rows of both kinds every score is 0; an empty table gives no
    rows; other columns of ``docs`` are never read.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, most))

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(model.value.scores(batch["text"].to_pylist()), pa.float64())], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (fold() == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """``docs`` without the rows scored THRESHOLD or more; all columns pass through."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, most))

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.value.scores(batch["text"].to_pylist()) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
