"""Scores by a class-based bigram model whose classes come from Brown's exchange clustering.

log P(text) is the sum over its words, and the end, of log P(class | class before) +
log P(word | class). Every word of the training texts has a class by exchange. First the most
frequent words and, as one unit each, all other words of an ending move, one unit at a time, to
the class that raises the likelihood of the class bigrams most. Then each of the other words leaves
its ending for the class that gains most on the counts of its own neighbours' classes. Class
bigrams are counted anew with these classes. A word never seen has the class of its ending.

The statistics of units have a fixed size; all counts cover every training text. A fixed number of
frequent words with their counts and classes is broadcast. All others stay in a table by word:
documents' (row, word) rows meet it in a join, and what is found goes back to the document's own
sequence of classes, in which only those places were open.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import as_bytes, stored, words

#: Units: the end, single words, endings. Classes: the end's, and those that words move between;
#: a class is stored as one byte.
ENDINGS, UNITS, CLASSES = 512, 2048, 96
SINGLE = UNITS - ENDINGS - 1
#: Rounds of exchange; frequent words whose counts are broadcast.
ROUNDS, FREQUENT = 4, 1 << 18
#: Bytes of text whose tokens are coded together in a task, and a worker's cache of endings.
CHUNK, CACHED = 12 << 20, 300_000
END = 0  # its word id, unit and class
#: Columns that scoring adds.
RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


class _Endings(dict):
    """9 bits of a hash of a word's last bytes."""

    def __missing__(self, ending: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[ending] = found = xxhash.xxh3_64_intdigest(ending) % ENDINGS
        return found


_endings = _Endings()


def _hashed(words: list[bytes]) -> np.ndarray:
    """Word ids: 55 bits of a hash of the word, 9 bits of one of its ending."""
    code = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    ending = np.fromiter((_endings[w[-4:]] for w in words), np.uint64, len(words))
    code = (code & ~np.uint64(ENDINGS - 1)) | ending
    code[code == END] = ENDINGS
    return code


def word_ids(text: bytes | None) -> np.ndarray:
    """Ids of a text's words, then that of the end."""
    return np.append(_hashed(words(text)), np.uint64(END))


@dataclass
class Tokens:
    """The tokens of some texts one after another, each text's words and its end.

    Each distinct word is hashed and looked up once: `ids` holds these, that of the end first, and
    `at` each token's place in there. `edges` are the places where texts begin, and the last end.
    """

    ids: np.ndarray
    at: np.ndarray
    edges: np.ndarray


def _tokens(texts: pa.Array) -> Tokens:
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    found = lists.flatten().dictionary_encode()
    distinct = as_bytes(found.dictionary)
    at = found.indices.to_numpy() + 1
    if b"" in distinct:  # white space around a text
        at[at == distinct.index(b"") + 1] = END
    real = at != END
    before = np.append(0, np.cumsum(real))
    # where the words of a text end, and an end of the text is put in
    ends = before[np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)]
    return Tokens(
        np.append(np.uint64(END), _hashed(distinct)),
        np.insert(at[real], ends, END),
        np.append(0, ends + np.arange(1, len(ends) + 1)),
    )


def _cut(texts: pa.Array):
    """Slices of texts that hold about CHUNK bytes, or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        n = max(1, int(np.searchsorted(ends, done + CHUNK, side="right")) - at)
        yield texts.slice(at, n)
        at += n


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _chunks(batches):
    """Tokens of many texts together."""
    parts, size = [], 0
    for batch in batches:
        for texts in _cut(batch.column(0)):
            parts.append(texts)
            size += texts.nbytes
            if size >= CHUNK:
                yield _tokens(pa.concat_arrays(parts))
                parts, size = [], 0
    if parts:
        yield _tokens(pa.concat_arrays(parts))


def word_counts(texts: DataFrame) -> DataFrame:
    """word and c: how often each word id, and the end, occurs."""

    def count(batches):
        for tokens in _chunks(batches):
            n = np.bincount(tokens.at, minlength=len(tokens.ids))
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([_long(tokens.ids[some]), pa.array(n[some])], ["word", "n"])

    return texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _ending(ids: np.ndarray) -> np.ndarray:
    """The unit of each word's ending; that of the end is its own."""
    unit = (SINGLE + 1 + (ids & np.uint64(ENDINGS - 1))).astype(np.int64)
    unit[ids == END] = END
    return unit


@dataclass
class Frequent:
    """Sorted ids of the frequent words with their counts and units, and, once these are known,
    their classes. `least` is the least weight (see _weight) of a frequent word."""

    words: np.ndarray
    counts: np.ndarray
    units: np.ndarray
    least: int
    classes: np.ndarray | None = None

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each id's place among the frequent words, and whether it is there."""
        if not len(self.words):
            return np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
        at = np.minimum(np.searchsorted(self.words, ids), len(self.words) - 1)
        return at, self.words[at] == ids

    def units_of(self, ids: np.ndarray) -> np.ndarray:
        unit = _ending(ids)
        at, known = self.find(ids)
        unit[known] = self.units[at[known]]
        return unit


def _weight() -> Column:
    """Orders words by count; equal counts by bits of the hash, so a cut can go between them."""
    return F.col("c") * 256 + F.shiftrightunsigned("word", 9).bitwiseAND(255)


def frequent_words(counts: DataFrame) -> Frequent:
    """At most FREQUENT words, down to a weight that a histogram of weights (32 bins an octave)
    gives; none if more words than that share the top bin. The SINGLE first are units."""
    words = counts.filter(F.col("word") != END)
    bins = words.groupBy(F.floor(F.log2(_weight().cast("double")) * 32).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min(_weight()).alias("least")
    )
    total, least = 0, 1 << 62
    for row in sorted(bins.collect(), reverse=True):
        total += row["n"]
        if total > FREQUENT:
            break
        least = row["least"]
    top = words.filter(_weight() >= least).select("word", "c").toArrow()
    ids, n = top["word"].to_numpy().view(np.uint64), top["c"].to_numpy()
    first = np.lexsort((ids, -n))[:SINGLE]
    units = _ending(ids)
    units[first] = np.arange(1, len(first) + 1)
    order = np.argsort(ids)
    return Frequent(ids[order], n[order], units[order], least)


def unit_bigrams(texts: DataFrame, frequent) -> np.ndarray:
    """How often each unit follows each other one; a matrix of fixed size."""

    def count(batches):
        for tokens in _chunks(batches):
            unit = frequent.value.units_of(tokens.ids)[tokens.at]
            pair = np.bincount(np.concatenate([[END], unit[:-1]]) * UNITS + unit, minlength=UNITS**2)
            some = np.flatnonzero(pair)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(pair[some])], ["pair", "n"])

    found = texts.select("text").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table = found.toArrow()
    out = np.zeros(UNITS**2)
    out[table["pair"].to_numpy()] = table["n"].to_numpy()
    return out.reshape(UNITS, UNITS)


def _entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """The class of each unit. Starts from frequency, then moves each unit, most frequent first,
    to the class that raises the likelihood of the class bigrams most; until nothing moves."""
    size = bigrams.sum(axis=0)
    order = [u for u in np.argsort(-size, kind="stable") if u != END and size[u] > 0]
    group = np.full(len(bigrams), 1)
    group[END] = END
    for i, u in enumerate(order):
        group[u] = 1 + i % (classes - 1)
    one = np.eye(classes)[group]
    table = one.T @ bigrams @ one
    for _ in range(rounds):
        moved = 0
        for u in order:
            old, own = group[u], bigrams[u, u]
            before = np.bincount(group, bigrams[:, u], classes)
            after = np.bincount(group, bigrams[u], classes)
            before[old] -= own
            after[old] -= own
            table[:, old] -= before
            table[old] -= after
            table[old, old] -= own
            # likelihood with the unit in each class: its column, its row, its own cell, margins
            gain = (_entropy(table + before[:, None]) - _entropy(table)).sum(axis=0)
            gain += (_entropy(table + after) - _entropy(table)).sum(axis=1)
            cell = np.diag(table)
            gain += _entropy(cell + before + after + own) - _entropy(cell + before) - _entropy(cell + after) + _entropy(cell)
            rows, columns = table.sum(axis=1), table.sum(axis=0)
            gain -= _entropy(rows + size[u]) - _entropy(rows) + _entropy(columns + size[u]) - _entropy(columns)
            gain[END] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[old] + 1e-9:
                best = old
            table[:, best] += before
            table[best] += after
            table[best, best] += own
            group[u] = best
            moved += best != old
        if not moved:
            break
    return group


#: Words whose neighbours are counted side by side, and class pairs of words read at once.
WORDS_AT_ONCE, PAIRS_AT_ONCE = 4096, 1 << 22


def neighbours(texts: DataFrame, frequent, start: np.ndarray) -> DataFrame:
    """word and pairs: for words that are no units of their own, the classes (by unit) before and
    after each occurrence, two bytes each, in one row for each stretch of text."""

    def gather(batches):
        for tokens in _chunks(batches):
            unit = frequent.value.units_of(tokens.ids)
            group = start[unit].astype(np.uint8)[tokens.at]
            pairs = np.stack([np.concatenate([group[-1:], group[:-1]]), np.concatenate([group[1:], group[:1]])], 1)
            own = np.flatnonzero((unit > SINGLE)[tokens.at])
            if not len(own):
                continue
            own = own[np.argsort(tokens.at[own], kind="stable")]
            n = np.bincount(tokens.at[own], minlength=len(tokens.ids))
            some = np.flatnonzero(n)
            edges = pa.py_buffer((2 * np.append(0, np.cumsum(n[some]))).astype(np.int32))
            data = pa.Array.from_buffers(pa.binary(), len(some), [None, edges, pa.py_buffer(pairs[own].tobytes())])
            yield pa.RecordBatch.from_arrays([_long(tokens.ids[some]), data], ["word", "pairs"])

    return texts.select("text").mapInArrow(gather, "word long, pairs binary")


def _best(word: np.ndarray, pairs: np.ndarray, gains) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted words, one entry of `word` for each of the `pairs`: each with its count and the
    class that gains most."""
    before, after, margin = gains
    ids, first, c = np.unique(word, return_index=True, return_counts=True)
    best = np.empty(len(ids), np.int64)
    for at in range(0, len(ids), WORDS_AT_ONCE):
        n = min(WORDS_AT_ONCE, len(ids) - at)
        some = pairs[first[at] : first[at] + c[at : at + n].sum()]
        row = np.repeat(np.arange(n) * CLASSES, c[at : at + n])
        left, right = (np.bincount(row + some[:, i], minlength=n * CLASSES).reshape(n, CLASSES) for i in (0, 1))
        gain = left @ before + right @ after - c[at : at + n, None] * margin
        gain[:, END] = -np.inf
        best[at : at + n] = gain.argmax(axis=1)
    return ids, c, best


def assign(found: DataFrame, table: np.ndarray) -> DataFrame:
    """word, c and class of all words in `found` (see neighbours), by the class bigrams `table`.

    A word's move to a class adds its neighbours' counts to a row and a column of the table. The
    gain in likelihood is taken to first order, which is what a word that is rare next to its
    class can change: the log of the cells it adds to, less the logs of the class's margins.
    """
    cells, size = np.log(table + 0.5), np.log(table.sum(axis=0) + 0.5)
    gains = cells, cells.T.copy(), size + np.log(table.sum(axis=1) + 0.5)

    def choose(batches):
        # a word's rows follow each other; the last word of a batch may go on in the next
        open_word, open_left, open_right, open_count = None, None, None, 0

        def close():
            gain = open_left @ gains[0] + open_right @ gains[1] - open_count * gains[2]
            gain[END] = -np.inf
            return [open_word], [open_count], [gain.argmax()]

        def out(word, c, group):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(x), k) for x, k in zip((word, c, group), (pa.int64(), pa.int64(), pa.int32()))],
                ["word", "c", "class"],
            )

        for batch in _slices(batches):
            _, edges, data = batch["pairs"].buffers()
            edges = np.frombuffer(edges, np.int32, batch.num_rows + 1, 4 * batch["pairs"].offset)
            pairs = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]].reshape(-1, 2)
            word = np.repeat(batch["word"].to_numpy(), np.diff(edges) // 2)
            if open_word is not None and word[0] != open_word:
                yield out(*close())
                open_word = None
            tail = np.searchsorted(word, word[-1])
            if open_word is not None:
                head = np.searchsorted(word, word[0], side="right")
                open_left += np.bincount(pairs[:head, 0], minlength=CLASSES)
                open_right += np.bincount(pairs[:head, 1], minlength=CLASSES)
                open_count += int(head)
                if head == len(word):
                    continue
                yield out(*close())
                word, pairs, tail = word[head:], pairs[head:], tail - head
            if tail:
                yield out(*_best(word[:tail], pairs[:tail], gains))
            open_word, open_count = word[-1], len(word) - int(tail)
            open_left, open_right = (np.bincount(pairs[tail:, i], minlength=CLASSES) for i in (0, 1))
        if open_word is not None:
            yield out(*close())

    rows = found.repartition("word").sortWithinPartitions("word")
    return rows.mapInArrow(choose, "word long, c long, class int")


def _slices(batches):
    """Batches cut so that each holds about PAIRS_AT_ONCE pairs at most, or one row."""
    for batch in batches:
        batch = pa.RecordBatch.from_arrays([batch["word"], batch["pairs"].cast(pa.binary())], ["word", "pairs"])
        ends = np.cumsum(pc.binary_length(batch["pairs"]).to_numpy() // 2, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")) - at)
            yield batch.slice(at, n)
            at += n


@dataclass
class Model:
    frequent: Frequent
    endings: np.ndarray  # class of each unit; words never seen have that of their ending
    transitions: np.ndarray  # log10 P(class | class before)
    sizes: np.ndarray  # tokens of each class
    discount: float
    unseen: np.ndarray  # log10 P(a word never seen | class)
    tokens: int
    types: int
    ends: int
    lexicon: DataFrame | None = None

    def emission(self, count: np.ndarray, group: np.ndarray) -> np.ndarray:
        """log10 P(word | class) of words by their count; the end is all of its class."""
        with np.errstate(divide="ignore", invalid="ignore"):
            seen = np.log10((count - self.discount) / np.maximum(self.sizes[group], 1))
        return np.where(group == END, 0.0, np.where(count > 0, seen, self.unseen[group]))


def coded(
    docs: DataFrame, rest: list[str], frequent: Frequent, endings: np.ndarray, lexicon: DataFrame, model: Model | None = None
) -> DataFrame:
    """Rows of docs (text, and the columns `rest`) with their words' classes and rare words.

    group: a byte a token; a rare word's is that of its ending. rare and places: ids of the words
    that are not frequent and where they are. found: what the lexicon holds of these (word, c,
    class). With a model also what ends and frequent words add up to: known (how many), base (log10
    of one more than their counts) and part (their log10 chances in their classes).
    """
    model = model and Model(**{**vars(model), "lexicon": None})
    shared = docs.sparkSession.sparkContext.broadcast((frequent, endings, model))

    def read(batches):
        frequent, endings, model = shared.value
        for batch in batches:
            at = 0
            for texts in _cut(batch["text"]):
                tokens = _tokens(texts)
                ids = tokens.ids
                where, known = frequent.find(ids)
                classes = endings[_ending(ids)]
                classes[known] = frequent.classes[where[known]]
                spot = np.flatnonzero((~known & (ids != END))[tokens.at])
                # how many open places each text has, and where its own first token is
                edges = np.searchsorted(spot, tokens.edges).astype(np.int32)
                places = spot - np.repeat(tokens.edges[:-1], np.diff(edges))
                lists = [
                    pa.ListArray.from_arrays(pa.array(edges), _long(ids[tokens.at[spot]])),
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(places.astype(np.int32))),
                ]
                group = pa.Array.from_buffers(
                    pa.binary(), len(texts),
                    [None, pa.py_buffer(tokens.edges.astype(np.int32)), pa.py_buffer(classes.astype(np.uint8)[tokens.at].tobytes())],
                )
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c].slice(at, len(texts)) for c in ["row", *rest]), group, *lists, *added(model, frequent, tokens, where, known, classes)],
                    names,
                )
                at += len(texts)

    def added(model, frequent, tokens, where, known, classes):
        """What ends and frequent words add up to, text by text."""
        if not model:
            return []
        count = np.where(known, frequent.counts[where] if len(frequent.counts) else 0, 0)
        count[END], known[END] = model.ends, True
        base, part = np.log10(count + 1.0), model.emission(count, classes)
        sums = []
        for first, end in zip(tokens.edges[:-1], tokens.edges[1:]):
            own = tokens.at[first:end]
            own = own[known[own]]
            sums.append((int((count[own] > 0).sum()), float(base[own].sum()), float(part[own].sum())))
        return [pa.array(list(x), k) for x, k in zip(zip(*sums), (pa.int64(), pa.float64(), pa.float64()))]

    names = ["row", *rest, "group", "rare", "places", *(("known", "base", "part") if model else ())]

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), *rest, "text")
    sums = ["0L known", "0D base", "0D part"] if model else []
    schema = numbered.drop("text").selectExpr(
        "*", "binary('') group", "array(0L) rare", "array(0) places", *sums
    ).schema
    first = stored(docs.sparkSession, numbered.mapInArrow(read, schema), "coded")
    asked = first.select("row", F.explode(F.array_distinct("rare")).alias("word"))
    met = asked.join(lexicon, "word").groupBy("row").agg(F.collect_list(F.struct("word", "c", "class")).alias("found"))
    return first.join(met, "row", "left")


def _filled(batch: pa.RecordBatch):
    """Per row of `coded`: the classes of its tokens; places and counts of its rare words."""
    columns = [batch[c] for c in ("group", "rare", "places", "found")]
    for given, rare, places, found in zip(*columns):
        group = np.frombuffer(given.as_py(), np.uint8).astype(np.int64)
        rare, places, found = rare.values.to_numpy(), places.values.to_numpy(), found.values
        count = np.zeros(len(rare), np.int64)
        if found is not None and len(found):
            word, c, kind = (found.field(n).to_numpy() for n in ("word", "c", "class"))
            order = np.argsort(word)
            at = order[np.minimum(np.searchsorted(word, rare, sorter=order), len(word) - 1)]
            seen = word[at] == rare
            count[seen] = c[at[seen]]
            group[places[seen]] = kind[at[seen]]
        yield group, places, count


def class_bigrams(rows: DataFrame) -> np.ndarray:
    """How often each class follows each other one in rows of `coded`."""

    def count(batches):
        total = np.zeros(CLASSES**2, np.int64)
        for batch in batches:
            for group, *_ in _filled(batch):
                total += np.bincount(np.concatenate([[END], group[:-1]]) * CLASSES + group, minlength=CLASSES**2)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pair", "n"])

    found = rows.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(CLASSES**2)
    table[found["pair"].to_numpy()] = found["n"].to_numpy()
    return table.reshape(CLASSES, CLASSES)


def train(texts: DataFrame) -> Model:
    """Fit on every text (null: empty). Without texts all words are unseen, all classes alike."""
    spark = texts.sparkSession
    texts = texts.select("text")
    counts = stored(spark, word_counts(texts), "counts")
    total = counts.agg(
        F.sum("c"), F.count(F.lit(1)), F.sum(F.when(F.col("word") == END, F.col("c"))),
        F.sum((F.col("c") == 1).cast("long")), F.sum((F.col("c") == 2).cast("long")),
    ).first()
    tokens, types, ends, once, twice = (x or 0 for x in total)
    frequent = frequent_words(counts)
    shared = spark.sparkContext.broadcast(frequent)
    bigrams = unit_bigrams(texts, shared)
    start = exchange(bigrams)
    one = np.eye(CLASSES)[start]
    found = assign(neighbours(texts, shared, start), one.T @ bigrams @ one)
    lexicon = stored(spark, found, "lexicon")
    # the frequent ones among them, as many as are broadcast already
    moved = lexicon.filter(_weight() >= frequent.least).toArrow()
    frequent.classes = start[frequent.units]
    at, _ = frequent.find(moved["word"].to_numpy().view(np.uint64))
    frequent.classes[at] = moved["class"].to_numpy()
    kinds = np.bincount(frequent.classes[(frequent.units <= SINGLE)], minlength=CLASSES)
    for group, n in lexicon.groupBy("class").count().collect():
        kinds[group] += n
    table = class_bigrams(coded(texts, [], frequent, start, lexicon))
    sizes = table.sum(axis=0)
    # Witten-Bell: as much weight for the classes' own frequency as a class has followers
    share = (sizes + 1) / (sizes.sum() + CLASSES)
    rows, followers = table.sum(axis=1, keepdims=True), (table > 0).sum(axis=1, keepdims=True)
    transitions = np.log10((table + np.maximum(followers, 1) * share) / (rows + np.maximum(followers, 1)))
    # absolute discounting: what words of a class give up is the chance of a new word there
    discount = min(0.9, max(0.1, once / max(1, once + 2 * twice)))
    unseen = np.where(sizes > 0, np.log10(np.maximum(discount * kinds, 1e-12) / np.maximum(sizes, 1)), 0.0)
    return Model(frequent, start, transitions, sizes, discount, unseen, tokens, types, ends, lexicon)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs without text, with n_tokens, n_known, train_tokens, base_score and score.

    Every row is scored by its whole text; a null or empty text is the end alone. base_score is
    that of single words with add-one smoothing; both are log10 probabilities. Columns of docs
    that bear a result's name give way to it; any others are kept, whatever their names.
    """
    given = [c for c in docs.columns if c.lower() not in ("text", *RESULTS)]
    rest = [f"given_{i}" for i in range(len(given))]
    rows = coded(
        docs.select(*(docs[c].alias(r) for c, r in zip(given, rest)), "text"),
        rest, model.frequent, model.endings, model.lexicon, model,
    )
    model = Model(**{**vars(model), "lexicon": None})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    log_total = float(np.log10(model.tokens + model.types + 1))

    def add_up(batches):
        model = shared.value
        for batch in batches:
            sums = {c: [] for c in RESULTS}
            numbers = (batch[c].to_pylist() for c in ("known", "base", "part"))
            for (group, places, count), known, base, part in zip(_filled(batch), *numbers):
                steps = model.transitions[np.concatenate([[END], group[:-1]]), group].sum()
                base += float(np.log10(count + 1.0).sum()) - len(group) * log_total
                sums["n_tokens"].append(len(group))
                sums["n_known"].append(known + int((count > 0).sum()))
                sums["train_tokens"].append(model.tokens)
                sums["base_score"].append(base)
                sums["score"].append(part + float(steps + model.emission(count, group[places]).sum()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in rest), *(pa.array(sums[c], k) for c, k in zip(RESULTS, kinds))], [*rest, *RESULTS]
            )

    schema = rows.select(*rest).selectExpr(
        "*", "0L n_tokens", "0L n_known", "0L train_tokens", "0D base_score", "0D score"
    ).schema
    out = rows.mapInArrow(add_up, schema)
    return out.select(*(F.col(r).alias(c) for c, r in zip(given, rest)), *RESULTS)
