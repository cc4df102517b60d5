"""Secret scans: fixed patterns, and formats learned by grammar inference.

The fixed patterns give labelled credentials: values after a key word (assign), access keys and long hex
runs. For each of the three a probabilistic automaton is learned: the prefix tree of all its values, whose states are
merged wherever their counts are statistically compatible (Hoeffding bounds on the next-symbol frequencies of
both states and, recursively, of their successors). A value's length is the first symbol that it shows, and a format
keeps to its lengths: a run that is less than half as long as the labelled values, or more than twice as long, isn't
of it (of the values' lengths a share of LOW at either end doesn't count). Every run of RUN that no
pattern covers, of whatever length, is then scored by its log-likelihood, and becomes a span of kind
"format" if a credential automaton explains it far better than ordinary text does.

Ordinary text is what is left of the runs when the credentials among them are taken out, since a corpus
holds bare credentials too and must not learn from them that they are ordinary. So runs are a mixture of
the credential automata and a background. The background is first a chain of first order, which is too plain to
learn a rare format; in each of ROUNDS rounds every run's share in it is computed and its frequencies are
counted anew by these shares. In the end an automaton merged from runs that are mostly its own joins the chain, with
half of the weight. A format that ordinary text uses often stays in the background, and its runs are no credentials.

A run is a span if the odds of the mixture are CERTAIN or better, and if its symbols are as likely as those
of labelled values, each scored by the automaton of the half of the values that it isn't in: at most LOW of
these may be below, with an allowance of one over the square root of the length. Runs without small letters
are also tried in small letters.

Symbols are classes of characters (digits, a-f, g-z, A-F, G-Z, each mark by itself); how a class is
spread over its characters is the same under all automata and cancels out.

Trees. Prefixes are counted by tasks and added up, first those of up to STRIDE symbols; those with at least two values
go on to twice as many, and so forth, so where a tree ends depends on counts, not on lengths. The driver merges
the states of a tree's MOST_NODES most frequent prefixes, which are a tree too, as no prefix is rarer than what it begins. All frequencies and
thresholds come from all values and runs at their full lengths. Scanning covers all of every text.

Defined results: null and empty texts have no spans; rows are scanned one by one, so repeated rows repeat
their result; texts and runs of any length are scanned whole; a corpus without labelled credentials learns no
automaton and adds no spans; an empty table gives no rows; other columns, whatever their names, aren't read by
``scan`` and pass through ``redact``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .session import settle, ship, work_dir

# The patterns that the operator's contract states.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "format")
LABELLED = KINDS[:3]

_HINTS = ("passw", "secret", "token", "api")
STRIDE, MOST_NODES = 64, 20_000
ALPHA = 0.05
#: Least log odds of a span, rounds of the mixture, the share of labelled values that may lie below the least rate, and the bins of rates.
CERTAIN, ROUNDS, LOW, RATE_BINS = 3.0, 4, 0.05, 100
#: The share of a length's probability that is the same for every corpus: 1 / (n (n + 1)).
ANY_LENGTH = 0.1

SYMBOLS = "dhlHU+/_.=-"
_CLASSES = (("d", "0123456789"), ("h", "abcdef"), ("l", "ghijklmnopqrstuvwxyz"), ("H", "ABCDEF"), ("U", "GHIJKLMNOPQRSTUVWXYZ"), *((c, c) for c in "+/_.=-"))
_TABLE = bytearray(256)
for _s, _characters in _CLASSES:
    for _c in _characters.encode():
        _TABLE[_c] = ord(_s)
#: Runs of symbols in a text of classes; shorter ones can't be values, by the contract's least length.
RUN = re.compile(r"[dhlHU+/_.=-]{6,}")
_SMALL = str.maketrans("HU", "hl")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the fixed patterns' matches, by start and kind."""
    found: list[Span] = []
    lowered = text.lower()
    if any(h in lowered for h in _HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def classes_of(text: str) -> str:
    """One symbol for each byte of the text; bytes that no run may hold are zeros."""
    return text.encode().translate(_TABLE).decode("latin-1")


def candidates(text: str, base: list[Span]) -> Iterator[tuple[int, int, str]]:
    """(start, end, symbols) of the runs that no span of ``base`` touches; places are bytes."""
    spans = [(a, b) for a, _, b in base]
    if spans and not text.isascii():
        spans = [(len(text[:a].encode()), len(text[:b].encode())) for a, b in spans]
    k = 0
    for m in RUN.finditer(classes_of(text)):
        a, b = m.span()
        while k < len(spans) and spans[k][1] <= a:
            k += 1
        if not any(s < b and e > a for s, e in spans[k : k + 4]):
            yield a, b, m[0]


def length_symbol(n: int) -> str:
    """The length itself up to 128, the next power of two beyond."""
    return f"#{n if n <= 128 else 1 << (n - 1).bit_length()}"


#: (prefix, next symbol, longer prefix, how many words have it), prefixes by their hashes.
Edge = tuple[int, str, int, float]
ROOT = 0


class Automaton:
    """A probabilistic automaton over symbols; the first symbol of every word is its length.

    ``next`` holds each state's successors, state 0 reads the length. As the length fixes where a word ends,
    states have no final weights. Probabilities are smoothed by those of the symbols in all states.
    """

    def __init__(self, words: Iterable[str] = (), alpha: float = ALPHA, tree: Iterable[Edge] = ()) -> None:
        """From words, or from the edges of their prefix tree, parents first."""
        self.next: list[dict[str, int]] = [{}]
        self.weight: list[dict[str, float]] = [{}]
        places = {ROOT: 0}
        for parent, s, node, n in tree:
            places[node] = self._add(places[parent], s, n)
        for word in words:
            at = 0
            for s in (length_symbol(len(word)), *word):
                at = self._add(at, s, 1)
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self._estimate()

    def _add(self, at: int, s: str, n: float) -> int:
        if s not in self.next[at]:
            self.next[at][s] = len(self.next)
            self.next.append({})
            self.weight.append({})
        self.weight[at][s] = self.weight[at].get(s, 0) + n
        return self.next[at][s]

    @classmethod
    def chain(cls) -> Automaton:
        """A first-order chain: one state for each symbol that was read last, and one before all."""
        a = cls([])
        after = {s: 2 + i for i, s in enumerate(SYMBOLS)}
        a.next, a.begin = [{}, dict(after), *(dict(after) for _ in SYMBOLS)], 1
        a.recount({})
        return a

    def _compatible(self, p: int, q: int) -> bool:
        todo, seen = [(p, q)], set()
        while todo:
            p, q = todo.pop()
            if p == q or (p, q) in seen:
                continue
            seen.add((p, q))
            x, y = self.weight[p], self.weight[q]
            n, m = sum(x.values()), sum(y.values())
            if not n or not m:
                continue
            room = self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            for s in x.keys() | y.keys():
                if abs(x.get(s, 0) / n - y.get(s, 0) / m) > room:
                    return False
                if s in x and s in y:
                    todo.append((self.next[p][s], self.next[q][s]))
        return True

    def _fold(self, p: int, q: int) -> None:
        """Adds the tree below q to the state p."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            for s, t in self.next[q].items():
                self.weight[p][s] = self.weight[p].get(s, 0) + self.weight[q][s]
                if s in self.next[p]:
                    todo.append((self.next[p][s], t))
                else:
                    self.next[p][s] = t

    def _merge_states(self) -> None:
        kept = [0]
        while True:
            fringe = [(self.weight[p][s], p, s, t) for p in kept for s, t in self.next[p].items() if t not in kept]
            if not fringe:
                break
            _, p, s, q = max(fringe, key=lambda x: (x[0], -x[1], x[2]))
            for r in kept[1:]:
                if self._compatible(r, q):
                    self.next[p][s] = r
                    self._fold(r, q)
                    break
            else:
                kept.append(q)
        keep = {p: i for i, p in enumerate(kept)}
        self.next, self.weight = [{s: keep[t] for s, t in self.next[p].items()} for p in kept], [self.weight[p] for p in kept]
        lengths = self.weight[0]
        #: The state after a length that was never seen: that after the most frequent one.
        self.begin = self.next[0][max(lengths, key=lambda s: (lengths[s], s))] if lengths else 0

    def _estimate(self) -> None:
        total: dict[str, float] = defaultdict(float)
        for x in self.weight[1:]:
            for s, n in x.items():
                total[s] += n
        size = sum(total.values()) + 0.5 * len(SYMBOLS)
        share = {s: (total[s] + 0.5) / size for s in SYMBOLS}
        self.logs = [{}] + [{s: math.log((x.get(s, 0) + 0.5 * share[s]) / (sum(x.values()) + 0.5)) for s in SYMBOLS} for x in self.weight[1:]]
        if len(self.logs) == 1:
            self.logs[0] = {s: math.log(share[s]) for s in SYMBOLS}
        self.n_words = sum(self.weight[0].values())

    def visits(self, word: str) -> Iterator[tuple[int, str]]:
        """The states that the word passes, each with the symbol read there."""
        s = length_symbol(len(word))
        yield 0, s
        at = self.next[0].get(s, self.begin)
        for s in word:
            yield at, s
            at = self.next[at].get(s, at)

    def recount(self, counts: dict[tuple[int, str], float]) -> None:
        """Keeps the states and takes their frequencies from counts of visits."""
        self.weight = [{} for _ in self.next]
        for (p, s), n in counts.items():
            self.weight[p][s] = n
        self._estimate()

    def length_likelihood(self, n: int) -> float:
        seen = self.weight[0].get(length_symbol(n), 0) / self.n_words if self.n_words else 1 / (n * (n + 1))
        return math.log((1 - ANY_LENGTH) * seen + ANY_LENGTH / (n * (n + 1)))

    def lengths(self) -> tuple[float, float]:
        """Half of the least and twice the greatest length of the words, but for a share of LOW at either end."""
        seen = sorted((int(s[1:]), n) for s, n in self.weight[0].items())
        room = LOW * self.n_words

        def end(counts: list[tuple[int, float]]) -> int:
            passed = 0.0
            for length, n in counts:
                passed += n
                if passed > room:
                    return length
            return 0

        return end(seen) / 2, 2 * end(seen[::-1])

    def symbol_likelihood(self, word: str) -> float:
        """Log-likelihood of the symbols, given the length; where no transition was seen, the state stays."""
        at, total = self.next[0].get(length_symbol(len(word)), self.begin), 0.0
        for s in word:
            total += self.logs[at][s]
            at = self.next[at].get(s, at)
        return total

    def log_likelihood(self, word: str) -> float:
        return self.length_likelihood(len(word)) + self.symbol_likelihood(word)


class Formats:
    """Credential automata with their least rates, those of the background, and the mixture's log odds; small enough to send to every task."""

    def __init__(self, credentials: list[Automaton], rates: list[float], background: list[Automaton], prior: list[float]) -> None:
        self.credentials, self.rates, self.background, self.prior = credentials, rates, background, prior
        self.lengths = [a.lengths() for a in credentials]

    def ordinary(self, word: str) -> float:
        """The background's log-likelihood; its automata have equal weights."""
        each = [a.log_likelihood(word) for a in self.background]
        best = max(each)
        return best + math.log(sum(math.exp(x - best) for x in each) / len(each))

    def log_odds(self, word: str) -> list[float]:
        """Of each credential automaton against the background; minus infinity where the symbols are too unlikely or the length isn't the format's."""
        if not any(least <= len(word) <= most for least, most in self.lengths):
            return [-math.inf] * len(self.credentials)
        ordinary = self.ordinary(word)
        forms = [word] if "h" in word or "l" in word else [word, word.translate(_SMALL)]
        found = []
        for a, rate, prior, (least, most) in zip(self.credentials, self.rates, self.prior, self.lengths, strict=True):
            if not least <= len(word) <= most:
                found.append(-math.inf)
                continue
            symbols = max(a.symbol_likelihood(x) for x in forms)
            typical = symbols / len(word) >= rate - 1 / math.sqrt(len(word))
            found.append(prior + a.length_likelihood(len(word)) + symbols - ordinary if typical else -math.inf)
        return found

    def shares(self, word: str) -> list[float]:
        """Of each credential automaton in a run; the rest is the background's."""
        odds = [math.exp(min(x, 50.0)) for x in self.log_odds(word)]
        return [x / (1 + sum(odds)) for x in odds]

    def accepts(self, word: str) -> bool:
        return max(self.log_odds(word), default=-math.inf) >= CERTAIN


class Scanner:
    """Spans of texts; remembers the verdicts on runs, which depend on their symbols alone."""

    MOST = 300_000

    def __init__(self, formats: Formats) -> None:
        self.formats, self.known = formats, {}

    def accepts(self, word: str) -> bool:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.MOST:
                self.known.clear()
            found = self.formats.accepts(word)
            if len(word) <= 64:
                self.known[word] = found
        return found

    def spans(self, text: str) -> list[Span]:
        base = base_spans(text)
        if not self.formats.credentials or not any(map(self.accepts, set(RUN.findall(classes_of(text))))):
            return base
        more = [(a, b) for a, b, word in candidates(text, base) if self.accepts(word)]
        if more and not text.isascii():
            raw = text.encode()
            more = [(len(raw[:a].decode()), len(raw[:b].decode())) for a, b in more]
        return sorted(base + [(a, 3, b) for a, b in more])


def _texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The labelled values and the symbols of ordinary runs of each batch: (kind, value, h, n)."""
    for batch in batches:
        labelled: dict[tuple[str, str], int] = defaultdict(int)
        ordinary: Counter[str] = Counter()
        for text in _texts(batch.column(0)):
            base = base_spans(text)
            for a, kind, b in base:
                labelled[KINDS[kind], text[a:b] if kind else ASSIGN.match(text, a)[2]] += 1
            ordinary.update([word for _, _, word in candidates(text, base)] if base else RUN.findall(classes_of(text)))
        rows = [(kind, v, _digest(v), n) for (kind, v), n in labelled.items()]
        rows += [("ordinary", v, _digest(v), n) for v, n in ordinary.items()]
        yield _columns(rows, kind=pa.string(), value=pa.string(), h=pa.int64(), n=pa.int64())


def _digest(value: str) -> int:
    return xxhash.xxh3_64_intdigest(value.encode()) >> 1


def _columns(rows: list[tuple], **types: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types.values())], names=list(types))


def _summed(values: DataFrame, tally) -> dict[tuple[int, int, str], float]:
    """Sums by (a, b, s) of what ``tally`` makes of every value: pairs of such a key and a number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, str], float] = defaultdict(float)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for key, n in tally(*row):
                    sums[key] += n
        yield _columns([(*key, n) for key, n in sums.items()], a=pa.int64(), b=pa.int64(), s=pa.string(), n=pa.float64())

    found = values.select("kind", "value", "h", "n").mapInArrow(run, "a long, b long, s string, n double")
    return {(r.a, r.b, r.s): r.n for r in found.groupBy("a", "b", "s").agg(F.sum("n").alias("n")).collect()}


def _trees(values: DataFrame, words, path: str) -> dict[int, list[Edge]]:
    """Prefix trees of what ``words`` makes of every value: pairs of a tree's number and a word that counts once."""

    def count(begin: int, end: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                nodes: dict[int, list] = {}
                last: list[tuple[str, str, int, int, int]] = []
                for kind, value, h, n in zip(*(c.to_pylist() for c in batch.columns[:4]), strict=True):
                    for tree, word in words(kind, value, h, n):
                        if begin and len(word) < begin:
                            continue
                        prefix, parent = xxhash.xxh3_64(f"{tree} "), ROOT
                        for depth, s in enumerate((length_symbol(len(word)), *word[: end - 1])):
                            prefix.update(s)
                            node = prefix.intdigest() >> 1
                            if depth >= begin:
                                held = nodes.setdefault(node, [tree, depth, parent, s, node, 0.0])
                                held[5] += 1
                            parent = node
                        if len(word) >= end:
                            last.append((kind, value, h, n, node))
                rows = [(*node, None, None, None, None) for node in nodes.values()]
                rows += [(None, None, None, None, node, None, kind, value, h, n) for kind, value, h, n, node in last]
                yield _columns(rows, tree=pa.int64(), depth=pa.int64(), parent=pa.int64(), s=pa.string(), node=pa.int64(), n=pa.float64(), kind=pa.string(), value=pa.string(), h=pa.int64(), times=pa.int64())

        return run

    spark, levels, begin, end, k = values.sparkSession, [], 0, STRIDE, 0
    open_ = values.select("kind", "value", "h", "n")
    while True:
        schema = "tree long, depth long, parent long, s string, node long, n double, kind string, value string, h long, times long"
        both = settle(open_.mapInArrow(count(begin, end), schema), f"{path}/prefixes-{k}")
        level = both.filter("tree is not null").groupBy("tree", "depth", "parent", "s", "node").agg(F.sum("n").alias("n"))
        level = settle(level, f"{path}/nodes-{k}")
        levels.append(f"{path}/nodes-{k}")
        # Words go on if their prefix so far is another word's too.
        shared = level.filter(f"depth = {end - 1} and n > 1").select("node").distinct()
        open_ = both.filter("tree is null").join(shared, "node", "left_semi").select("kind", "value", "h", F.col("times").alias("n")).distinct()
        open_ = settle(open_, f"{path}/open-{k}")
        if open_.isEmpty():
            break
        begin, end, k = end, 2 * end, k + 1
    nodes = spark.read.schema(level.schema).parquet(*levels)
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("n"), "depth", "node"))
    trees: dict[int, list[Edge]] = defaultdict(list)
    for r in nodes.withColumn("rank", rank).filter(F.col("rank") <= MOST_NODES).orderBy("tree", "depth", "parent", "s").collect():
        trees[r.tree].append((r.parent, r.s, r.node, r.n))
    return trees


def learn_formats(docs: DataFrame) -> Formats:
    """Automata and odds from what the fixed patterns find and leave in all of ``docs`` (text)."""
    ship(docs.sparkSession)
    values = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_values, "kind string, value string, h long, n long")
    path = work_dir(docs.sparkSession, "secrets")
    values = settle(values.groupBy("kind", "value", "h").agg(F.sum("n").alias("n")), f"{path}/values")
    found = {r.kind: (r.values, r.n) for r in values.groupBy("kind").agg(F.count("*").alias("values"), F.sum("n").alias("n")).collect()}
    kinds = [k for k in LABELLED if k in found]
    if not kinds:
        return Formats([], [], [Automaton.chain()], [])
    credentials, rates = _credentials(values.filter(F.col("kind") != "ordinary"), kinds, found, f"{path}/credentials")
    total = found.get("ordinary", (0, 0))[1]
    least = [math.log(found[k][1] / (total + found[k][1])) for k in kinds]
    formats = Formats(credentials, rates, [Automaton.chain()], list(least))
    if total:
        ordinary = values.filter(F.col("kind") == "ordinary")
        _separated(ordinary, formats, total, least, f"{path}/ordinary")
    return formats


def _credentials(values: DataFrame, kinds: list[str], found: dict[str, tuple[int, int]], path: str) -> tuple[list[Automaton], list[float]]:
    """Each kind's automaton, and its least log-likelihood of a symbol."""
    place = {kind: k for k, kind in enumerate(kinds)}

    # Of each kind one half of the values, the other, and both; every distinct value counts once.
    def halves(kind: str, value: str, h: int, n: int) -> Iterator[tuple[int, str]]:
        word = classes_of(value)
        yield 3 * place[kind] + (h & 1), word
        yield 3 * place[kind] + 2, word

    trees = _trees(values, halves, path)
    automata = [Automaton(tree=trees.get(i, ())) for i in range(3 * len(kinds))]

    def visits(kind: str, value: str, h: int, n: int) -> Iterator[tuple[tuple[int, int, str], int]]:
        word = classes_of(value)
        for i in (3 * place[kind] + (h & 1), 3 * place[kind] + 2):
            for p, s in automata[i].visits(word):
                yield (i, p, s), 1

    counts: list[dict[tuple[int, str], float]] = [{} for _ in automata]
    for (i, p, s), n in _summed(values, visits).items():
        counts[i][p, s] = n
    for a, c in zip(automata, counts, strict=True):
        a.recount(c)

    def rate(kind: str, value: str, h: int, n: int) -> Iterator[tuple[tuple[int, int, str], int]]:
        word = classes_of(value)
        yield (place[kind], math.floor(RATE_BINS * automata[3 * place[kind] + 1 - (h & 1)].symbol_likelihood(word) / len(word)), ""), 1

    binned = _summed(values, rate)
    rates = []
    for k, kind in enumerate(kinds):
        below, room = 0.0, LOW * found[kind][0]
        for b in sorted(b for i, b, _ in binned if i == k):
            below += binned[k, b, ""]
            if below > room:
                rates.append(b / RATE_BINS)
                break
    return automata[2::3], rates


def _separated(ordinary: DataFrame, formats: Formats, total: int, least: list[float], path: str) -> None:
    """Fits the background and the odds of ``formats`` to the ordinary runs, whose credentials are taken out."""

    def tally(background: Automaton, first: bool = False):
        def of(kind: str, value: str, h: int, n: int) -> Iterator[tuple[tuple[int, int, str], float]]:
            shares = [0.0] * len(formats.credentials) if first else formats.shares(value)
            own = n * (1 - sum(shares))
            for k, x in enumerate(shares):
                if x:
                    yield (1, k, ""), n * x
            if own:
                for p, s in background.visits(value):
                    yield (0, p, s), own

        return of

    def again(background: Automaton, first: bool = False) -> None:
        sums = _summed(ordinary, tally(background, first))
        background.recount({(p, s): n for (i, p, s), n in sums.items() if i == 0})
        if not first:
            hidden = [sums.get((1, k, ""), 0.0) for k in range(len(formats.credentials))]
            own = max(1.0, total - sum(hidden))
            formats.prior = [max(low, math.log(x / own)) if x > 0 else low for x, low in zip(hidden, least, strict=True)]

    chain = formats.background[0]
    again(chain, first=True)
    for _ in range(ROUNDS):
        again(chain)

    def own(kind: str, value: str, h: int, n: int) -> Iterator[tuple[int, str]]:
        if sum(formats.shares(value)) < 0.5:
            yield 0, value

    merged = Automaton(tree=_trees(ordinary, own, path).get(0, ()))
    again(merged)
    if merged.n_words:
        formats.background = [chain, merged]


def _named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, formats: Formats | None = None) -> DataFrame:
    """Spans of every row's text.

    Columns: doc_id; n_assign, n_access, n_hex and n_format; base_sha256 of the fixed patterns' spans;
    spans, all of them as kind:start:end joined by commas; found, the same as structs with their text.
    """
    formats = formats or learn_formats(docs)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(formats)
        for batch in batches:
            rows = []
            for text in _texts(batch.column(1)):
                spans = scanner.spans(text)
                n = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
                base = _named([s for s in spans if s[1] < 3])
                rows.append((*n, hashlib.sha256(base.encode()).hexdigest(), _named(spans), [{"kind": KINDS[k], "start": a, "end": b, "text": text[a:b]} for a, k, b in spans]))
            struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())]))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), struct]
            names = ["doc_id", "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans", "found"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names=names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string, found array<struct<kind:string,start:long,end:long,text:string>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def redact(docs: DataFrame, formats: Formats | None = None, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; overlapping spans are replaced as one."""
    formats = formats or learn_formats(docs)
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def clean(text: str | None, scanner: Scanner) -> str | None:
        spans = scanner.spans(text) if text else []
        if not spans:
            return text
        parts, end = [], 0
        for a, _, b in spans:
            if a >= end:
                parts += [text[end:a], mark]
            end = max(end, b)
        return "".join([*parts, text[end:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(formats)
        for batch in batches:
            texts = pa.array([clean(x, scanner) for x in batch.column(at).to_pylist()], pa.string())
            columns = [texts if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
