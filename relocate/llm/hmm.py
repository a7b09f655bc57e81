"""Hidden Markov language model over words.

Words fall into classes: each of the most frequent words is one, all others are grouped by a hash of their endings.
Latent states emit classes; a class emits its words by their counts. States are trained by Baum-Welch on all training
texts: each task adds up its expected counts, Spark adds those of all tasks, and only the sums, of a fixed size, come
to the driver. Every pass goes over all training texts, from the first on, until the likelihood settles. A text's
likelihood is that of the scaled forward recursion over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relocate.llm import exchange, shipped, words
from relocate.session import saved

BUCKETS = 4096
#: Tokens of the segments that a task starts together in a pass: they bound its memory and do not change what is counted.
START_TOKENS = 1 << 19
#: Passes end when one gains less than this, in nats a token.
SETTLED = 1e-3
ENTRY = np.dtype([("count", "<u4"), ("bucket", "<u2")])


@dataclass(frozen=True)
class Settings:
    states: int = 8
    frequent: int = 4096
    passes: int = 24  # over all training texts, at most
    first_passes: int = 6  # made in any case: states are alike at first, and the first gains may be small
    segment: int = 256  # training cuts texts into sequences of so many tokens; later ones begin in the steady state
    chain: int = 2048  # scoring runs longer texts as chained pieces; the result is the same
    seed: int = 1


@dataclass
class Model:
    frequent: np.ndarray  # sorted hashes of the frequent words
    frequent_counts: np.ndarray
    sums: np.ndarray  # training tokens by bucket, without the frequent words
    kinds: np.ndarray  # different training words by bucket, without the frequent ones
    tokens: int
    vocabulary: int
    ends: int
    start: np.ndarray | None = None  # of states
    move: np.ndarray | None = None  # state to state
    emit: np.ndarray | None = None  # class by state

    @property
    def end(self) -> int:
        """Class of the end; those of the frequent words and of the buckets come before it."""
        return len(self.frequent) + BUCKETS

    def classes(self, keys: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        if not len(self.frequent):
            return buckets.astype(np.int64)
        at = np.minimum(np.searchsorted(self.frequent, keys), len(self.frequent) - 1)
        return np.where(self.frequent[at] == keys, at, len(self.frequent) + buckets)

    def inside(self, classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 of the probability of each word in its class; of any unknown word together for unknown ones."""
        out = np.zeros(len(classes))
        rare = classes >= len(self.frequent)
        own = classes[rare] - len(self.frequent)
        kinds, total = self.kinds[own], self.sums[own] + self.kinds[own]
        share = np.where(counts[rare] > 0, counts[rare], kinds)
        out[rare] = np.log10(np.where(total > 0, share, 1) / np.maximum(total, 1))
        return out


# --- tokens -----------------------------------------------------------------------------------------------------------


def _buckets(found: words.Words, at: np.ndarray) -> np.ndarray:
    """Bucket of words by their last three bytes, lower-cased, and whether they are longer than four."""
    starts, ends = found.starts[at], found.ends[at]
    out = (ends - starts > 4).astype(np.uint64)
    for back in (1, 2, 3):
        place = ends - back
        byte = np.where(place >= starts, found.data[np.maximum(place, 0)] if len(found.data) else 0, 0)
        byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
        out = out * np.uint64(257) + byte.astype(np.uint64)
    return (words.mixed(out) % np.uint64(BUCKETS)).astype(np.uint16)


_TOKENS = (
    "block_id long, ids array<long>, held array<boolean>, sizes array<int>, keys binary, counts binary, buckets binary, tokens binary"
)


def _tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for at, to, found in words.slices(batch.column(1)):
            held = batch.column(2).slice(at, to - at)
            keys, first, tokens = np.unique(found.hashes(lower=True), return_index=True, return_inverse=True)
            training = ~np.array(held.to_pylist(), bool)[found.texts_of()]
            entries = np.zeros(len(keys), ENTRY)
            entries["count"] = np.bincount(tokens[training], minlength=len(keys))
            entries["bucket"] = _buckets(found, first)
            blob = tokens.astype(np.uint32).tobytes()
            yield pa.RecordBatch.from_pydict(
                {
                    "block_id": pa.array([number], pa.int64()),
                    "ids": pa.array([batch.column(0).slice(at, to - at).to_pylist()], pa.list_(pa.int64())),
                    "held": pa.array([held.to_pylist()], pa.list_(pa.bool_())),
                    "sizes": pa.array([np.diff(found.bounds).astype(np.int32)], pa.list_(pa.int32())),
                    "keys": pa.array([keys.tobytes()], pa.binary()),
                    "counts": pa.array([entries.tobytes()], pa.binary()),
                    "buckets": pa.array([entries["bucket"].tobytes()], pa.binary()),
                    "tokens": pa.array([pa.compress(blob, "zstd", asbytes=True)], pa.binary()),
                }
            )
            number += 1


def _sequences(row: dict, model: Model, training: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the texts of a block, each with its end, their sizes with the end; and keys and tokens."""
    keys = np.frombuffer(row["keys"], np.uint64)
    sizes = np.array(row["sizes"], np.int64)
    raw = pa.decompress(row["tokens"], 4 * int(sizes.sum()), "zstd", asbytes=True) if sizes.sum() else b""
    tokens = np.frombuffer(raw, np.uint32)
    of_key = model.classes(keys, np.frombuffer(row["buckets"], np.uint16))
    with_end = np.full(len(tokens) + len(sizes), model.end, np.int64)
    place = np.arange(len(tokens)) + np.repeat(np.arange(len(sizes)), sizes)
    with_end[place] = of_key[tokens]
    sizes = sizes + 1
    if training:
        use = ~np.array(row["held"], bool)
        with_end, sizes = with_end[np.repeat(use, sizes)], sizes[use]
    return with_end, sizes, of_key, tokens


def _padded(sequence: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``table[t, s]`` for sequences sorted by falling size, and how many are running at each step."""
    longest = int(sizes[0]) if len(sizes) else 0
    running = len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), "right")
    table = np.zeros((longest, len(sizes)), np.int32)
    for t in range(longest):
        table[t, : running[t]] = sequence[begin[: running[t]] + t]
    return table, running


def _segments(sizes: np.ndarray, segment: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length, text and number in it of each segment."""
    pieces = -(-sizes // segment)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = (np.cumsum(sizes) - sizes)[owner] + turn * segment
    return begin, np.minimum(sizes[owner] - turn * segment, segment), owner, turn


def _steady(move: np.ndarray) -> np.ndarray:
    """The shares of states that moves leave as they are."""
    return np.linalg.matrix_power(move, 1 << 10).mean(axis=0)


# --- Baum-Welch -------------------------------------------------------------------------------------------------------


class Counts:
    """Expected counts of transitions, starts and emissions."""

    def __init__(self, classes: int, states: int):
        self.emit = np.zeros((classes, states))
        self.move = np.zeros((states, states))
        self.start = np.zeros(states)
        self.log, self.tokens = 0.0, 0

    def add(self, classes: np.ndarray, sizes: np.ndarray, model: Model, segment: int, at_once: int = START_TOKENS) -> None:
        """Add texts, cut into segments, of which about ``at_once`` tokens are worked on together."""
        begin, length, _, turn = _segments(sizes, segment)
        order = np.argsort(-length, kind="stable")
        step = max(1, at_once // segment)
        for at in range(0, len(order), step):
            some = order[at : at + step]
            self._add(*_padded(classes, begin[some], length[some]), turn[some] == 0, model)

    def _add(self, table: np.ndarray, running: np.ndarray, head: np.ndarray, model: Model) -> None:
        steps, width = table.shape
        first = np.where(head[:, None], model.start, _steady(model.move)).astype(np.float32)
        states = len(model.start)
        move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)
        # a product with ones adds up states, for each of them
        back_move, ones = np.ascontiguousarray(move.T), np.ones((states, states), np.float32)
        forward = np.zeros((steps, width, states), np.float32)
        scale = np.ones((steps, width), np.float32)
        for t in range(steps):
            n = running[t]
            now = emit.take(table[t, :n], axis=0)
            now *= forward[t - 1, :n] @ move if t else first[:n]
            total = now @ ones
            np.divide(now, total, out=forward[t, :n])
            scale[t, :n] = total[:, 0]
        # from here on forward becomes the share of each state at each step
        back = np.ones((width, states), np.float32)
        for t in range(steps - 1, -1, -1):
            n = running[t]
            if t + 1 < steps:
                m = running[t + 1]
                ahead = emit.take(table[t + 1, :m], axis=0)
                ahead *= back[:m]
                ahead /= scale[t + 1, :m, None]
                self.move += forward[t, :m].T @ ahead
                np.matmul(ahead, back_move, out=back[:m])
            forward[t, :n] *= back[:n]
        live = np.arange(width)[None, :] < running[:, None]
        shares, classes = forward[live], table[live]
        shares /= shares @ ones
        for k in range(states):
            self.emit[:, k] += np.bincount(classes, weights=shares[:, k], minlength=len(self.emit))
        if steps:
            own = forward[0][head]
            self.start += (own / own.sum(axis=1, keepdims=True)).sum(axis=0)
        self.log += float(np.log(scale[live]).sum(dtype=np.float64))
        self.tokens += int(live.sum())

    def rows(self) -> np.ndarray:
        return np.concatenate([self.emit, self.move, self.start[None, :]])


def _updated(model: Model, rows: np.ndarray, share: np.ndarray) -> Model:
    """Parameters from expected counts; ``share`` of classes smooths the emissions."""
    states = len(model.start)
    emit, move, start = rows[: -states - 1], rows[-states - 1 : -1] * model.move, rows[-1]
    emit = emit + share[:, None] * states
    move = move + 0.1
    start = start + 0.1
    model.emit, model.move, model.start = emit / emit.sum(axis=0), move / move.sum(axis=1, keepdims=True), start / start.sum()
    return model


def _trained(tokens: DataFrame, model: Model, settings: Settings) -> Model:
    states, classes = settings.states, model.end + 1
    seen = np.zeros(classes)
    seen[len(model.frequent) : -1] = model.sums
    seen[: len(model.frequent)] = model.frequent_counts
    seen[-1] = model.ends
    share = (seen + 1) / (seen + 1).sum()
    random = np.random.Generator(np.random.PCG64(settings.seed))
    model.emit = share[:, None] * random.uniform(0.5, 1.5, (classes, states))
    model.emit /= model.emit.sum(axis=0)
    # most moves stay, for what a text keeps; some go on to the next state, for what changes from word to word
    model.move = 0.1 / states + 0.7 * np.eye(states) + 0.2 * np.roll(np.eye(states), 1, axis=1)
    model.start = np.full(states, 1 / states)

    before, last = None, np.inf
    for made in range(1, settings.passes + 1):
        names = [f"s{k}" for k in range(states)]
        counted = tokens.select("sizes", "held", "keys", "buckets", "tokens").mapInArrow(
            _counting(model, settings.segment, START_TOKENS), "place int, " + ", ".join(f"{n} double" for n in names)
        )
        rows, log, seen_tokens = np.zeros((classes + states + 1, states)), 0.0, 0.0
        for row in counted.groupBy("place").agg(*[F.sum(n).alias(n) for n in names]).collect():
            if row[0] == _LOG:
                log = row[1]
            elif row[0] == _SEEN:
                seen_tokens = row[1]
            else:
                rows[row[0]] = row[1:]
        model = _updated(model, rows, share)
        gain = np.inf if before is None else log - before
        # a gain that is small and grows comes before states part, not after
        if not seen_tokens or (made > settings.first_passes and gain < SETTLED * seen_tokens and gain <= last):
            break
        before, last = log, gain
    return model


#: Places of the likelihood and of the tokens it is of, among those of counts.
_LOG, _SEEN = -1, -2


def _counting(model: Model, segment: int, at_once: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(*model.emit.shape)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                sequence, sizes, _, _ = _sequences(row, model, training=True)
                counts.add(sequence, sizes, model, segment, at_once)
        rows = counts.rows()
        full = np.flatnonzero(rows.any(axis=1))
        said = np.zeros((2, rows.shape[1]))
        said[:, 0] = counts.log, counts.tokens
        rows, full = np.concatenate([rows[full], said]), np.concatenate([full, [_LOG, _SEEN]])
        columns = {"place": pa.array(full, pa.int32())} | {f"s{k}": pa.array(rows[:, k]) for k in range(rows.shape[1])}
        yield pa.RecordBatch.from_pydict(columns)

    return count


# --- scoring ----------------------------------------------------------------------------------------------------------


def likelihoods(sequence: np.ndarray, sizes: np.ndarray, model: Model, chain: int) -> np.ndarray:
    """log10 of the probability of the classes of each text, by the scaled forward recursion.

    A text longer than ``chain`` is cut into pieces. Each later piece runs once from every state, all pieces at once;
    the results are then chained from the first to the last.
    """
    states = len(model.start)
    pieces = -(-sizes // chain)
    owner = np.repeat(np.arange(len(sizes)), pieces)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    runs = np.where(turn == 0, 1, states)
    owner, turn, state = np.repeat(owner, runs), np.repeat(turn, runs), np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    begin = (np.cumsum(sizes) - sizes)[owner] + turn * chain
    length = np.minimum(sizes[owner] - turn * chain, chain)
    order = np.argsort(-length, kind="stable")
    log, last = np.zeros(len(order)), np.zeros((len(order), states))
    for at in range(0, len(order), 4096):
        some = order[at : at + 4096]
        table, running = _padded(sequence, begin[some], length[some])
        first = np.where((turn[some] == 0)[:, None], model.start, model.move[state[some]])
        now = np.zeros((len(some), states))
        for t in range(len(table)):
            n = running[t]
            step = model.emit[table[t, :n]]
            step *= now[:n] @ model.move if t else first[:n]
            total = step.sum(axis=1)
            step /= total[:, None]
            now[:n] = step
            log[some[:n]] += np.log(total)
        last[some] = now
    head = np.flatnonzero(turn == 0)
    out = log[head].copy()
    for text in np.flatnonzero(pieces > 1):
        vector, at = last[head[text]], head[text] + 1
        for _ in range(int(pieces[text]) - 1):
            logs, ends = log[at : at + states], last[at : at + states]
            most = logs.max()
            vector = (vector * np.exp(logs - most)) @ ends
            total = vector.sum()
            out[text] += most + np.log(total)
            vector, at = vector / total, at + states
    return out / np.log(10)


def _scoring(model: Model, ranges: int, chain: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                sequence, sizes, of_key, tokens = _sequences(row, model, training=False)
                counts = exchange.totals_of(np.frombuffer(row["keys"], np.uint64), ranges, row["parts"] or [])
                owner = np.repeat(np.arange(len(sizes)), sizes - 1)
                added = lambda x: np.bincount(owner, weights=x[tokens], minlength=len(sizes))
                room = np.log10(model.tokens + model.vocabulary + 1)
                base = added(np.log10(counts + 1.0)) + np.log10(model.ends + 1.0) - sizes * room
                known = added((counts > 0).astype(float)).astype(np.int64) + int(model.ends > 0)
                total = likelihoods(sequence, sizes, model, chain) + added(model.inside(of_key, counts))
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": pa.array(row["ids"], pa.int64()),
                        "held_out": pa.array(row["held"], pa.bool_()),
                        "n_tokens": pa.array(sizes),
                        "n_known": pa.array(known),
                        "train_tokens": pa.array(np.full(len(sizes), model.tokens)),
                        "base_score": pa.array(base),
                        "score": pa.array(total),
                    }
                )

    return score


# --- operator ---------------------------------------------------------------------------------------------------------


def scored(
    docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Score every text of ``docs`` by a hidden Markov model trained on those not held out.

    Held out is a text when crc32 of its id as text, modulo 7, is 2. Returns ``id_col, held_out, n_tokens, n_known,
    train_tokens, base_score, score``: a row for each row, repeated ones too; ``base_score`` is that of add-one word
    counts. Tokens are words, lower-cased A-Z, and one end. Null and empty texts are an end alone; a null id counts as
    an empty one. Without training texts all words are unknown. An empty table gives no rows; other columns are ignored.
    """
    settings = settings or Settings()
    shipped(docs.sparkSession)
    number = docs[id_col].cast("long")
    held = F.crc32(F.coalesce(number.cast("string"), F.lit("")).cast("binary")) % 7 == 2
    texts = docs.select(number.alias("id"), docs[text_col].alias("text"), held.alias("held"))
    tokens = saved(texts.mapInArrow(_tokenized, _TOKENS), "hmm-tokens")

    sized = tokens.agg(F.coalesce(F.sum(F.octet_length("keys")), F.lit(0))).first()[0] // 8
    ranges = exchange.ranges_for(sized)
    # the most frequent keys of all are among the most frequent of each range
    totals = saved(exchange.summed(tokens, ranges, ENTRY, settings.frequent), "hmm-totals")
    model = _trained(tokens, _counted(tokens, totals, settings), settings)

    parts = exchange.gathered(totals.filter("block_id IS NOT NULL"), "totals")
    joined = tokens.select("block_id", "ids", "held", "sizes", "keys", "buckets", "tokens").join(parts, "block_id", "left")
    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return joined.mapInArrow(_scoring(model, ranges, settings.chain), schema).withColumnRenamed("id", id_col)


def _counted(tokens: DataFrame, totals: DataFrame, settings: Settings) -> Model:
    """Word counts of the training texts, as far as they are of a fixed size."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sums, kinds, top in zip(*(batch[c].to_pylist() for c in ("sums", "kinds", "top"))):
                size = 8 * (1 + np.iinfo(ENTRY["bucket"]).max)
                sums, kinds = (np.frombuffer(pa.decompress(x, size, "zstd", asbytes=True), np.int64) for x in (sums, kinds))
                own = np.frombuffer(top, exchange.TOP)
                full = np.flatnonzero(sums)
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array([None] * len(full) + own["key"].view(np.int64).tolist(), pa.int64()),
                        "bucket": pa.array(np.concatenate([full, own["bucket"]]), pa.int32()),
                        "total": pa.array(np.concatenate([sums[full], own["count"]]), pa.int64()),
                        "kinds": pa.array(np.concatenate([kinds[full], np.ones(len(own), np.int64)]), pa.int64()),
                    }
                )

    said = totals.filter("block_id IS NULL").select("sums", "kinds", "top").mapInArrow(
        listed, "key long, bucket int, total long, kinds long"
    )
    said = saved(said, "hmm-counts")
    sums, kinds = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for bucket, total, different in said.filter("key IS NULL").groupBy("bucket").agg(F.sum("total"), F.sum("kinds")).collect():
        sums[bucket], kinds[bucket] = total, different
    best = said.filter("key IS NOT NULL").orderBy(F.desc("total"), "key").limit(settings.frequent).collect()
    flat = tokens.select(F.explode("held").alias("held"))
    ends = flat.filter("NOT held").count()
    tokens, vocabulary = int(sums.sum()) + ends, int(kinds.sum()) + int(ends > 0)
    for row in best:
        sums[row["bucket"]] -= row["total"]
        kinds[row["bucket"]] -= 1
    frequent = np.array([row["key"] for row in best], np.int64).view(np.uint64)
    order = np.argsort(frequent)
    counts = np.array([row["total"] for row in best], np.int64)[order]
    return Model(frequent[order], counts, sums, kinds, tokens, vocabulary, ends)
