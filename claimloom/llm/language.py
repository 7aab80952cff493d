"""Language identification by cross-parsing.

Each language is a suffix automaton of a bounded sample of its labelled text. A text is cut
greedily into the longest phrases that occur in a language's sample. A phrase costs the
bits that name its place in the sample, so languages with samples of different sizes can be
compared; the cheapest language explains the text best. The automata walk many stretches
of text side by side, one array step per symbol.
"""

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm import textkernels as K

# Most letters of training text per language, and of all languages together. A language with less
# text has a smaller sample; it leaves the others theirs.
TRAIN_LETTERS = 30_000
TRAIN_TOTAL = 240_000

# Rows of labelled text that are looked at per language to fill the sample.
TRAIN_ROWS = 400

# More labels than this are an error, not cut off: the tables of all languages are in memory together.
MAX_LANGUAGES = 100

# Symbols after which a parse begins a new phrase in every language, so that
# stretches of a long text can be walked side by side.
STRETCH = 512
LANES = 8192

UNKNOWN = "und"

# Phrases per letter beyond which no learned language explains a text. Text in a learned language
# needs about a sixth of that.
MOST_PHRASES = 0.7

_BREAK = np.int32(1 << 30)


@lru_cache(maxsize=1)
def _letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    table = np.zeros(0x110000, bool)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000:
            table[code] = chr(code).isalpha()
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def symbols(points: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Alphabet positions of a text; a run of other characters is one space (0).

    Letters outside the alphabet are its last number.
    """
    letter = _letter_table()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points, letter = points[keep], letter[keep]
    at = np.searchsorted(alphabet, points)
    at[at == len(alphabet)] = 0
    known = alphabet[at] == points if len(alphabet) else np.zeros(len(points), bool)
    return np.where(letter, np.where(known, at + 1, len(alphabet) + 1), 0).astype(np.int32)


def suffix_automaton(sequence: np.ndarray) -> list[dict[int, int]]:
    """Transitions per state of the suffix automaton of a sequence."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in sequence.tolist():
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


class Tables:
    """Parse tables of all languages' samples; the states of all are numbered through.

    Most states of a suffix automaton have one way on, which is kept as a symbol and a state. Only
    the others have a row of next states, as wide as the symbols of their own sample. A set ``_BREAK`` bit
    says that a new phrase begins; row 0 of a language holds only these.
    """

    def __init__(self, samples: tuple[str, ...]):
        points = [code_points(s) for s in samples]
        seen = np.unique(np.concatenate(points))
        #: Letters of all samples.
        self.alphabet = seen[_letter_table()[seen]]
        #: Column of a symbol in the rows of each language; 0 where its sample has none.
        self.columns = np.zeros((len(samples), len(self.alphabet) + 2), np.int32)
        #: First state of each language.
        self.first: list[int] = []
        rows, row_of, symbol, target = [], [], [], []
        states = cells = 0
        for k, p in enumerate(points):
            given = symbols(p, self.alphabet)
            own = np.unique(given)
            self.columns[k, own] = np.arange(1, len(own) + 1)
            step = suffix_automaton(self.columns[k, given])
            wide = [state for state, to in enumerate(step) if state and len(to) > 1]
            table = np.zeros((len(wide) + 1, len(own) + 1), np.int32)
            table[0, list(step[0])] = list(step[0].values())
            # In the root no phrase is open: any symbol begins one.
            table[:] = (table[0] + states) | _BREAK
            for row, state in enumerate(wide, 1):
                to = step[state]
                table[row, list(to)] = np.array(list(to.values())) + states
            at = np.zeros(len(step), np.int64)
            at[wide] = np.arange(1, len(wide) + 1)
            only = [next(iter(to.items())) if state and len(to) == 1 else (-1, 0) for state, to in enumerate(step)]
            ways = np.array(only, np.int32).reshape(-1, 2)
            rows.append(table.ravel())
            row_of.append(at * table.shape[1] + cells)
            symbol.append(ways[:, 0])
            target.append(ways[:, 1] + np.int32(states))
            self.first.append(states)
            states += len(step)
            cells += table.size
        self.cells, self.row_of = np.concatenate(rows), np.concatenate(row_of)
        self.symbol, self.target = np.concatenate(symbol), np.concatenate(target)

    def next(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Next states (with ``_BREAK``) of ``state[language, lane]`` after a symbol per lane."""
        column = self.columns[:, symbol]
        return np.where(self.symbol[state] == column, self.target[state], self.cells[self.row_of[state] + column])


@lru_cache(maxsize=2)
def _tables(samples: tuple[str, ...]) -> Tables:
    return Tables(samples)


def phrase_counts(texts: list[str], samples: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases per text and language, and letters per text."""
    tables = _tables(samples)
    langs = len(tables.first)
    coded = [symbols(code_points(t), tables.alphabet) for t in texts]
    letters = np.array([int((c > 0).sum()) for c in coded], np.int64)
    counts = np.zeros((len(texts), langs), np.int64)
    lengths = np.array([len(c) for c in coded], np.int64)
    flat = np.concatenate([*coded, np.zeros(0, np.int32)])
    stretches = -(-lengths // STRETCH)
    owner = np.repeat(np.arange(len(texts)), stretches)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    begin = np.repeat(np.cumsum(lengths) - lengths, stretches) + place * STRETCH
    many = np.minimum(lengths[owner] - place * STRETCH, STRETCH)
    order = np.argsort(-many, kind="stable")
    roots = np.array(tables.first, np.int32)[:, None]
    mask = _BREAK - 1
    for low in range(0, len(order), LANES):
        lanes = order[low : low + LANES]
        begins, left = begin[lanes], many[lanes]
        state = np.repeat(roots, len(lanes), axis=1)
        found = np.zeros((langs, len(lanes)), np.int32)
        ends = np.searchsorted(-left, -np.arange(int(left[0])), side="left")
        for t in range(int(left[0])):
            n = int(ends[t])
            entry = tables.next(state[:, :n], flat[begins[:n] + t])
            found[:, :n] += entry >> 30
            state[:, :n] = entry & mask
        for k in range(langs):
            counts[:, k] += np.bincount(owner[lanes], weights=found[k], minlength=len(texts)).astype(np.int64)
    return counts, letters


def even_share(sizes: list[int], total: int) -> int:
    """The largest number at which all sizes, cut to it, sum to at most ``total``."""
    for i, size in enumerate(sorted(sizes)):
        share = total // (len(sizes) - i)
        if size > share:
            return share
        total -= size
    return max(sizes, default=0)


def samples_of(
    labelled: DataFrame, lang_col: str, text_col: str, id_col: str, letters: int = TRAIN_LETTERS, rows: int = TRAIN_ROWS
) -> dict[str, str]:
    """Training text per language, from a bounded sample of the labelled rows.

    Row ids are hashed into ``rows`` slots per language and the smallest hash of a slot is
    taken, with the first characters of its text, so the sample has at most ``rows`` rows
    per language and does not depend on how the table is stored. Each language has at most
    ``letters``, whatever the others have; only when all together exceed ``TRAIN_TOTAL``, the
    longest samples are cut to an even share of it. Within a language the longest texts are cut
    to an even share of its letters, so that all its sampled rows count.
    """
    text, spot = F.col(text_col), F.xxhash64(F.col(id_col).cast("string"))
    part = F.substring(text, 1, max(200, 8 * letters // rows))
    slots = (
        labelled.filter(F.col(lang_col).isNotNull() & text.rlike(r"\p{L}"))
        .select(F.col(lang_col).alias("lang"), F.pmod(spot, F.lit(rows)).alias("slot"), spot.alias("spot"), part.alias("part"))
        .groupBy("lang", "slot")
        .agg(F.min(F.struct("spot", "part")).alias("pick"))
    )
    parts: dict[str, list] = {}
    for row in slots.limit(MAX_LANGUAGES * rows + 1).collect():
        parts.setdefault(row.lang, []).append((row.slot, row.pick.part))
    if len(parts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} language labels")
    texts = {lang: [t for _, t in sorted(p)] for lang, p in sorted(parts.items())}
    # Each text counts with the space after it.
    sizes = {lang: [len(t) + 1 for t in given] for lang, given in texts.items()}
    share = min(letters, even_share([min(letters, sum(s)) for s in sizes.values()], TRAIN_TOTAL))
    most = {lang: max(1, even_share(s, share) - 1) for lang, s in sizes.items()}
    return {lang: " ".join(t[: most[lang]] for t in given)[:share] for lang, given in texts.items()}


def phrase_costs(counts: np.ndarray, letters: np.ndarray, samples: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Bits per text and language: of its phrases, and with each letter on its own where that is cheaper.

    A phrase of a sample with n letters takes log2(n + alphabet) bits, as the phrases per letter of a
    text in the sample's language fall with 1 / log2(n). The second figure keeps a sample of a few
    letters from winning texts that no sample explains.
    """
    size = len(_tables(samples).alphabet) + 2
    costs = counts * np.log2(np.array([len(s) for s in samples]) + size)
    return costs, np.minimum(costs, letters[:, None] * np.log2(size))


def _identify(texts: list[str], samples: dict[str, str]) -> tuple[list[str], list[float], np.ndarray]:
    """Language, score and phrases per letter (of the language with the fewest) of each text."""
    names = list(samples)
    if not names:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), np.ones(len(texts))
    known = tuple(samples.values())
    counts, letters = phrase_counts(texts, known)
    costs, least = phrase_costs(counts, letters, known)
    cheapest = least == least.min(axis=1, keepdims=True)
    best = np.where(cheapest, counts, np.iinfo(np.int64).max).argmin(axis=1)
    rows = np.arange(len(texts))
    own = costs[rows, best]
    costs[rows, best] = math.inf
    second = costs.min(axis=1)
    share = np.where(letters > 0, np.maximum(1 - own / np.maximum(second, 1), 0.0), 0.0)
    langs = [names[k] if n else UNKNOWN for k, n in zip(best, letters)]
    return langs, share.tolist(), counts.min(axis=1) / np.maximum(letters, 1)


def _texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Parts of a text column with the row each begins at."""
    for first, end, _, _ in K.blocks(column):
        yield first, [t or "" for t in column.slice(first, end - first).to_pylist()]


def identified(
    docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row, from the training text per language.

    ``score`` is how much cheaper the winner's phrases are than the runner-up's, as a share
    of the runner-up's cost (1 when only one language was learned). A text that is null or has
    no letter, or any text when nothing was learned, is ``und`` with score 0. Of equally
    cheap languages the one with fewer phrases wins, then the first by name. Rows with equal
    ids stay as they are.
    """

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for _, texts in _texts(batch.column(1)):
                found = _identify(texts, samples)
                langs += found[0]
                scores += found[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        identify, "doc_id long, lang_pred string, score double"
    )


def accepted(
    docs: DataFrame, samples: dict[str, str], most: float = MOST_PHRASES, text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known.

    A row goes when its language is ``und``, or when every language needs more than
    ``most`` phrases per letter, that is when no learned language explains the text.
    """
    at = docs.columns.index(text_col)

    def accept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for first, texts in _texts(batch.column(at)):
                langs, _, rate = _identify(texts, samples)
                keep[first : first + len(texts)] = (np.array(langs) != UNKNOWN) & (rate <= most)
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(accept, docs.schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from training: one fifth of the ids."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_samples(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> dict[str, str]:
    """Training text per language from the labelled rows that are not held out."""
    return samples_of(docs.filter(~held_out(id_col)), lang_col, text_col, id_col)


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out and predict the language of every row.

    Returns ``doc_id``, ``held_out``, ``lang_pred``, ``score``. Language, source and id
    are never inputs of a prediction. An empty table gives an empty result.
    """
    samples = training_samples(docs, id_col, text_col, lang_col)
    found = identified(docs, samples, id_col, text_col)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
