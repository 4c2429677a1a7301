"""Language-model scores: smoothed unigram counts, and a log-bilinear model trained by noise-contrastive estimation.

Counts cover every token of every training text. The neural model predicts a token's class from the classes of the two tokens
before it, and the token has its smoothed share of the counts in its class. Every counted word has a class: the most frequent
words, the anchors, are classes of their own. Anchors that occur together form groups (languages, for one); any other word belongs
to the group that leads in most of the stretches of text around its occurrences, and to a band of frequency in it. So each
word's context says something about the next one, and vocabulary, classes' members and events all grow with the corpus.

Class triples are counted over all training texts and stay distributed: in each round every task learns from its share of them,
starting from the same parameters, and the results are averaged by their weights. The parameters then give a table of log10
probabilities, normalised by batched matrix products.

The most frequent words go to every task as a table of bounded size; all other words of a document are joined with the
counts, with their log probability for each group they may belong to.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewarden.llm.common import heaviest, stored, text_of

FOLDS, HELD_OUT = 7, 2
#: Words that every task holds, and the longest of them in bytes: with counts under 40 MB.
HEAD_WORDS, HEAD_BYTES = 200_000, 64
#: Words with a class of their own, groups of them, and the counts at which bands of frequency begin.
ANCHORS, GROUPS, BANDS = 127, 8, (0, 30, 1_000)
#: Tokens of a stretch of text, whose anchors tell its group.
STRETCH = 32
#: A task reports the words with at least this share of the tokens it counted; anchors lie far above.
ANCHOR_SHARE = 1 / 20_000
WIDTH, STEPS, BATCH, NOISE, RATE, SEED = 24, 400, 4_096, 8, 0.15, 5
#: Rounds of training, and events of a task in each.
ROUNDS, TASK_EVENTS = 6, 200_000
MEMO_WORDS = 300_000
#: The token that ends every text. Words are never empty.
END = b""


def tokens(text: str) -> list[bytes]:
    """ASCII-lower-cased words between ASCII white space, and the end."""
    words = text.encode().lower().split()
    words.append(END)
    return words


def _rows(found: Counter, **more) -> pa.RecordBatch:
    columns = {"word": pa.array(found.keys(), pa.binary()), **{k: pa.array([v] * len(found), pa.int32()) for k, v in more.items()},
               "n": pa.array(found.values(), pa.int64())}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words that are frequent among those a task has counted."""
    def heavy(found: Counter) -> pa.RecordBatch:
        least = found.total() * ANCHOR_SHARE
        return _rows(Counter({w: n for w, n in found.items() if n >= least}))
    found: Counter = Counter()
    for text in (x.as_py() for batch in batches for x in batch.column("text")):
        found.update(tokens(text))
        if len(found) > MEMO_WORDS:
            yield heavy(found)
            found = Counter()
    yield heavy(found)


def _numbers(words: list[list[bytes]], index: dict[bytes, int], missing: int) -> np.ndarray:
    """The number of every word of all texts, `missing` where it has none."""
    get = index.get
    return np.array([get(w, missing) for part in words for w in part], dtype=np.int64)


class Stretches:
    """The stretches of texts and how often each anchor occurs in them; `anchor` is the anchor of every token, -1 for none."""

    def __init__(self, words: list[list[bytes]], anchor: np.ndarray, n_anchors: int):
        self.words = words
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.starts = np.cumsum(sizes) - sizes
        pieces = -(-sizes // STRETCH)
        first = np.cumsum(pieces) - pieces
        self.text_of_stretch = np.repeat(np.arange(len(sizes)), pieces)
        self.stretch = np.repeat(first, sizes) + (np.arange(sizes.sum()) - np.repeat(self.starts, sizes)) // STRETCH
        at = np.flatnonzero(anchor >= 0)
        self.counts = np.bincount(self.stretch[at] * n_anchors + anchor[at], minlength=len(self.text_of_stretch) * n_anchors).reshape(-1, max(1, n_anchors))

    def groups(self, group_of_anchor: np.ndarray, n_groups: int) -> np.ndarray:
        """The leading group of each token's stretch; of the whole text where the stretch has no anchor; else group 0."""
        member = np.zeros((self.counts.shape[1], n_groups), dtype=np.int64)
        member[np.arange(len(group_of_anchor)), group_of_anchor] = 1
        votes = self.counts @ member
        whole = np.zeros((len(self.words), n_groups), dtype=np.int64)
        np.add.at(whole, self.text_of_stretch, votes)
        lead = np.where(votes.any(axis=1), votes.argmax(axis=1), whole.argmax(axis=1)[self.text_of_stretch])
        return lead[self.stretch]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _together(anchors: list[bytes]):
    """How often two anchors occur in one stretch: the matrix of a task, a row per anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, n = {w: i for i, w in enumerate(anchors)}, len(anchors)
        found = np.zeros((n, n))
        for part in _slices(batches):
            words = [tokens(t) for t in part.column("text").to_pylist()]
            seen = np.minimum(Stretches(words, _numbers(words, index, -1), n).counts, 1).astype(np.float64)
            found += seen.T @ seen
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n), pa.int32()), pa.array(list(found), pa.list_(pa.float64()))], names=["i", "row"])
    return run


def group_anchors(together: np.ndarray, groups: int) -> np.ndarray:
    """The group of each anchor: k-means over the rows of positive pointwise mutual information, from far-apart beginnings."""
    n = len(together)
    if not n:
        return np.empty(0, dtype=np.int64)
    seen = np.diag(together).copy()
    seen[seen == 0] = 1
    lift = np.maximum(np.log((together + 1e-9) * seen.max() / np.outer(seen, seen)), 0)
    lift /= np.maximum(np.linalg.norm(lift, axis=1, keepdims=True), 1e-9)
    centre = [int(seen.argmax())]
    while len(centre) < min(groups, n):
        centre.append(int((lift @ lift[centre].T).max(axis=1).argmin()))
    middle = lift[centre]
    for _ in range(30):
        of = (lift @ middle.T).argmax(axis=1)
        middle = np.stack([lift[of == g].mean(axis=0) if (of == g).any() else middle[g] for g in range(len(middle))])
        middle /= np.maximum(np.linalg.norm(middle, axis=1, keepdims=True), 1e-9)
    return of


def _count(anchors: list[bytes], group_of_anchor: np.ndarray, groups: int):
    """(word, g, n): occurrences by the group of the stretch they stand in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w: i for i, w in enumerate(anchors)}
        found = [Counter() for _ in range(groups)]
        for part in _slices(batches):
            texts = [tokens(t) for t in part.column("text").to_pylist()]
            split = Stretches(texts, _numbers(texts, index, -1), len(anchors))
            group = split.groups(group_of_anchor, groups)
            for start, words in zip(split.starts.tolist(), split.words, strict=True):
                own = group[start:start + len(words)]
                cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(words)]
                for a, b in zip(cuts, cuts[1:]):
                    found[own[a]].update(words[a:b])
            if sum(map(len, found)) > MEMO_WORDS:
                yield from (_rows(x, g=g) for g, x in enumerate(found))
                found = [Counter() for _ in range(groups)]
        yield from (_rows(x, g=g) for g, x in enumerate(found))
    return run


class Classes:
    """Numbers of classes: 0 is nothing that is known, then the anchors, then groups times bands."""

    def __init__(self, anchors: int, groups: int):
        self.anchors, self.groups, self.bands = anchors, groups, len(BANDS)
        self.n = 1 + anchors + groups * self.bands

    def of(self, group, band):
        return 1 + self.anchors + group * self.bands + band

    @property
    def tails(self) -> np.ndarray:
        """The classes of words beyond the table, by group: those of the lowest band."""
        return self.of(np.arange(self.groups), 0)


def _codes(classes: np.ndarray, starts: np.ndarray, end: int, n: int) -> np.ndarray:
    """(second last, last, own) class of every token as one number. Ends stand before a text's first token."""
    one = np.append(end, classes[:-1])
    two = np.append(end, one[:-1])
    one[starts] = end
    two[starts] = end
    second = starts + 1
    two[second[second < len(classes)]] = end
    return (two * n + one) * n + classes


class Reader:
    """Class of every token: from the table of frequent words, else from the group of the stretch it stands in."""

    def __init__(self, model: dict):
        self.index = {w: i for i, w in enumerate(model["words"])}
        self.class_of, self.group_of_anchor, self.classes = np.append(model["class_of"], 0), model["group_of_anchor"], model["classes"]
        # All anchors are in the table, under the classes that follow 0.
        self.anchor_at = np.where((self.class_of > 0) & (self.class_of <= self.classes.anchors), self.class_of - 1, -1)
        self.end = int(self.class_of[self.index[END]]) if END in self.index else 0

    def read(self, texts: list[str]) -> tuple[Stretches, np.ndarray, np.ndarray]:
        """The texts' words; each token's place in the table, the table's size where it has none; its class."""
        words, size = [tokens(t) for t in texts], len(self.index)
        place = _numbers(words, self.index, size)
        split = Stretches(words, self.anchor_at[place], self.classes.anchors)
        group = split.groups(self.group_of_anchor, self.classes.groups)
        return split, place, np.where(place < size, self.class_of[place], self.classes.tails[group])


def _events(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shipped.value)
        n = reader.classes.n
        seen = np.zeros(n ** 3, dtype=np.int64)
        for part in _slices(batches):
            split, _, own = reader.read(part.column("text").to_pylist())
            code, k = np.unique(_codes(own, split.starts, reader.end, n), return_counts=True)
            seen[code] += k
        code = np.flatnonzero(seen)
        for at in range(0, len(code), 100_000):
            part = code[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[part])], names=["code", "n"])
    return run


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def start(seen: np.ndarray, width: int = WIDTH, seed: int = SEED) -> dict[str, np.ndarray]:
    """Parameters before the first step, with AdaGrad's sums, for classes seen so often as targets."""
    rng, n = np.random.default_rng(seed), len(seen)
    p = {"context": rng.normal(0, 0.1, (n, width)), "target": rng.normal(0, 0.1, (n, width)), "bias": np.log(seen / seen.sum()),
         "two": np.eye(width) * 0.5, "one": np.eye(width)}
    return p | {f"{k}+": np.full_like(v, 1e-2) for k, v in p.items()}


def learn(p: dict[str, np.ndarray], code: np.ndarray, count: np.ndarray, seen: np.ndarray, steps: int, batch: int = BATCH, noise: int = NOISE,
          rate: float = RATE, seed: int = SEED) -> dict[str, np.ndarray]:
    """Parameters after some steps of noise-contrastive estimation on counted events.

    Context vectors times a matrix per position predict a vector; its products with the target vectors, plus biases, are
    the scores. Each step tells a batch of events, drawn by their counts, from noise drawn by the class frequencies."""
    rng, n = np.random.default_rng(seed), len(seen)
    p = {k: v.copy() for k, v in p.items()}
    share = seen / seen.sum()
    total, noise_share = np.cumsum(count), np.cumsum(share)
    for _ in range(steps if len(code) else 0):
        drawn = code[np.searchsorted(total, rng.random(batch) * total[-1], side="right").clip(max=len(code) - 1)]
        two, one, own = drawn // (n * n), drawn // n % n, drawn % n
        other = np.searchsorted(noise_share, rng.random((batch, noise))).clip(max=n - 1)
        targets = np.column_stack([own, other])
        ctwo, cone = p["context"][two], p["context"][one]
        predicted = ctwo @ p["two"] + cone @ p["one"]
        vectors = p["target"][targets]
        score = (vectors @ predicted[:, :, None])[:, :, 0] + p["bias"][targets]
        error = -_sigmoid(score - np.log(noise * share[targets]))
        error[:, 0] += 1
        error /= batch
        pull = (error[:, :, None] * vectors).sum(axis=1)
        weight = np.bincount((np.arange(batch)[:, None] * n + targets).ravel(), weights=error.ravel(), minlength=batch * n).reshape(batch, n)
        by_context = np.zeros_like(p["context"])
        np.add.at(by_context, two, pull @ p["two"].T)
        np.add.at(by_context, one, pull @ p["one"].T)
        step = {"context": by_context, "target": weight.T @ predicted, "bias": weight.sum(axis=0), "two": ctwo.T @ pull, "one": cone.T @ pull}
        for k, g in step.items():
            p[f"{k}+"] += g * g
            p[k] += rate * g / np.sqrt(p[f"{k}+"])
    return p


def normalised(p: dict[str, np.ndarray]) -> np.ndarray:
    """log10 probability of each class after each pair of classes, [second last, last, own]."""
    scores = ((p["context"] @ p["two"] @ p["target"].T)[:, None, :] + (p["context"] @ p["one"] @ p["target"].T)[None, :, :] + p["bias"])
    scores -= scores.max(axis=2, keepdims=True)
    scores -= np.log(np.exp(scores).sum(axis=2, keepdims=True))
    return scores / np.log(10)


def _seen(code: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(code % n, weights=count, minlength=n) + 1.0


def train(code: np.ndarray, count: np.ndarray, n: int, steps: int = STEPS, batch: int = BATCH) -> np.ndarray:
    """The normalised table learnt from events that are all at hand."""
    seen = _seen(code, count, n)
    return normalised(learn(start(seen), code, count, seen, steps, batch))


_NAMES = ("context", "target", "bias", "two", "one")


def _packed(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k + s].ravel() for k in _NAMES for s in ("", "+")])


def _unpacked(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in (k + s for k in _NAMES for s in ("", "+")):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def train_in_rounds(events: DataFrame, n: int, steps: int, rounds: int = ROUNDS, task_events: int = TASK_EVENTS) -> np.ndarray:
    """The normalised table learnt from the stored events (code, n), which stay where they are: a round is a pass of every task over
    its part, in as many steps as it takes to draw it `steps` / STEPS times over, and the mean of the parameters by weight.
    A task gets some `task_events` events, in whatever number of files they are stored."""
    sums = events.groupBy((F.col("code") % n).alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    seen = np.ones(n)
    for r in sums:
        seen[r.c] += r.n
    spark, total = events.sparkSession, sum(r.k for r in sums)
    parts = max(1, -(-total // task_events))
    p = start(seen)
    for round_ in range(rounds if total else 0):
        shipped = spark.sparkContext.broadcast((p, seen))

        def run(batches: Iterator[pa.RecordBatch], shipped=shipped, round_=round_) -> Iterator[pa.RecordBatch]:
            p, seen = shipped.value
            rows = pa.Table.from_batches(batches, pa.schema([("code", pa.int64()), ("n", pa.int64())])).sort_by("code")
            if rows.num_rows:
                code, count = rows["code"].to_numpy(), rows["n"].to_numpy()
                due = max(1, -(-max(len(code), BATCH * STEPS // rounds) * steps // (BATCH * STEPS)))
                after = learn(p, code, count, seen, due, seed=SEED + 1000 * round_ + int(code[0] % 997))
                yield pa.RecordBatch.from_arrays([pa.array([float(count.sum())]), pa.array([_packed(after).tobytes()], pa.binary())], names=["w", "p"])
        found = events.coalesce(parts).mapInArrow(run, "w double, p binary").collect()
        found = sorted((r.w, bytes(r.p)) for r in found)
        flat = sum(w * np.frombuffer(x) for w, x in found) / sum(w for w, _ in found)
        p = _unpacked(flat, p)
    return normalised(p)


def fit(texts: DataFrame, head_words: int = HEAD_WORDS, steps: int = STEPS) -> dict:
    """The model of a table of texts (text): what every task needs, and the stored table of all words (word, c, g)."""
    spark = texts.sparkSession
    often = texts.mapInArrow(_frequent, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    anchors = [bytes(r.word) for r in often.orderBy(F.desc("n"), "word").limit(ANCHORS).collect()]
    together = np.zeros((len(anchors), len(anchors)))
    pairs = texts.mapInArrow(_together(anchors), "i int, row array<double>").select("i", F.posexplode("row").alias("j", "x"))
    for r in pairs.groupBy("i", "j").agg(F.sum("x").alias("x")).collect():
        together[r.i, r.j] = r.x
    group_of_anchor = group_anchors(together, GROUPS)
    by_group = texts.mapInArrow(_count(anchors, group_of_anchor, GROUPS), "word binary, g int, n long").groupBy("word").agg(
        F.sum("n").alias("c"), *[F.sum(F.when(F.col("g") == g, F.col("n")).otherwise(0)).alias(f"g{g}") for g in range(GROUPS)])
    lead = F.array(*[f"g{g}" for g in range(GROUPS)])
    counts = stored(by_group.select("word", "c", (F.array_position(lead, F.array_max(lead)) - 1).cast("int").alias("g")), "word-counts")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    weight = np.zeros(GROUPS)
    for r in counts.groupBy("g").agg(F.sum(F.col("c") + 1).alias("w")).collect():
        weight[r.g] = r.w

    head = heaviest(counts.where(F.octet_length("word") <= HEAD_BYTES), "c", head_words).select("word", "c", "g").toArrow()
    rows = set(zip(head["word"].to_pylist(), head["c"].to_pylist(), head["g"].to_pylist(), strict=True))
    rows |= {(bytes(r.word), r.c, r.g) for r in counts.where(F.col("word").isin(anchors)).collect()} if anchors else set()
    rows = sorted(rows, key=lambda r: (-r[1], r[0]))
    words, c, g = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=np.int64)
    classes = Classes(len(anchors), GROUPS)
    anchor_of = {w: i for i, w in enumerate(anchors)}
    own = np.array([anchor_of.get(w, -1) for w in words], dtype=np.int64)
    class_of = np.where(own >= 0, own + 1, classes.of(g, np.searchsorted(BANDS, c, side="right") - 1)).astype(np.int64)
    # What each class holds: the counts of its words, one more for each, and in groups one for a word that was never seen.
    held = np.bincount(class_of, weights=c + 1.0, minlength=classes.n).astype(np.float64)
    beyond = weight - np.bincount(g, weights=c + 1.0, minlength=GROUPS)
    held[classes.tails] += beyond
    held[1 + classes.anchors:] += 1
    model = {"words": words, "anchors": anchors, "class_of": class_of, "group_of_anchor": group_of_anchor, "classes": classes, "held": held,
             "log_count": np.log10(c + 1.0), "log_share": np.log10((c + 1.0) / held[class_of])}
    shipped = spark.sparkContext.broadcast(model)
    events = stored(texts.mapInArrow(_events(shipped), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "events")
    table = train_in_rounds(events, classes.n, steps)
    # A word that was never seen may belong to any class of a group.
    open_ = np.arange(1 + classes.anchors, classes.n)
    unseen = np.log10((10.0 ** table[:, :, open_] / held[open_]).sum(axis=2, keepdims=True))
    model["table"] = np.concatenate([table, unseen], axis=2).astype(np.float32)
    return model | {"counts": counts, "tokens": total.n, "types": total.v}


SCANNED = ("uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, lm double, "
           "tail array<struct<word:binary,n:int,logs:array<float>>>")
_TAIL = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32()), ("logs", pa.list_(pa.float32()))]))


def _scan(shipped):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        reader = Reader(model)
        n, size = reader.classes.n, len(model["words"])
        # The last entry stands for all words that aren't in the table; what they add comes from the join.
        log_count, log_share = np.append(model["log_count"], 0.0), np.append(model["log_share"], 0.0)
        table = model["table"].reshape(n * n, n + 1)
        choices = np.append(reader.classes.tails, n)
        for part in _slices(batches):
            split, place, own = reader.read(part.column("text").to_pylist())
            codes = _codes(own, split.starts, reader.end, n)
            known = place < size
            logs = np.where(known, table[codes // n, own].astype(np.float64) + log_share[place], 0.0)
            ends = np.append(split.starts[1:], len(own))
            tails = []
            for a, b, words in zip(split.starts.tolist(), ends.tolist(), split.words, strict=True):
                rest = np.flatnonzero(~known[a:b])
                names: dict[bytes, int] = {}
                which = np.array([names.setdefault(words[i], len(names)) for i in rest.tolist()], dtype=np.int64)
                sums = np.zeros((len(names), len(choices)))
                np.add.at(sums, which, table[codes[a + rest] // n][:, choices])
                times = np.bincount(which, minlength=len(names))
                tails.append([{"word": w, "n": int(k), "logs": x} for w, k, x in zip(names, times, sums.astype(np.float32))])
            add = lambda x: pa.array(np.add.reduceat(x, split.starts))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("uid", "doc_id", "held_out")), pa.array(ends - split.starts), add(known.astype(np.int64)),
                 add(log_count[place]), add(logs), pa.array(tails, _TAIL)],
                names=["uid", "doc_id", "held_out", "n_tokens", "known", "base", "lm", "tail"])
    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, held_out: int = HELD_OUT,
          head_words: int = HEAD_WORDS, steps: int = STEPS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of `docs`.

    Learnt from the texts whose crc32 of the id as text, modulo `folds`, is not `held_out`. base_score adds up
    log10((c + 1) / (N + V + 1)) over the tokens; score is the log10 probability of the text by the model, in which all words that no
    training text holds are one token. NULL and empty texts are one end. A row without an id is trained on;
    rows that repeat an id are texts of their own. An empty table gives an empty result; without training texts all tokens
    are unseen. Other columns are ignored, whatever their names; texts of any length are read whole."""
    rest = F.pmod(F.crc32(F.col(f"`{id_col}`").cast("long").cast("string").cast("binary")), F.lit(folds))
    plain = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.coalesce(rest == held_out, F.lit(False)).alias("held_out"), text_of(text_col).alias("text"))
    return score_with(fit(plain.where(~F.col("held_out")).select("text"), head_words, steps), plain)


def score_with(model: dict, plain: DataFrame) -> DataFrame:
    """Scores of texts (uid, doc_id, held_out, text) by a model of `fit`."""
    shipped = plain.sparkSession.sparkContext.broadcast({k: v for k, v in model.items() if k != "counts"})
    scanned = stored(plain.mapInArrow(_scan(shipped), SCANNED), "lm-scanned")
    tail = scanned.select("uid", F.explode("tail").alias("t")).select("uid", "t.*")
    held = F.array(*[F.lit(float(x)) for x in model["held"][model["classes"].tails]])
    own = F.coalesce(F.col("g"), F.lit(GROUPS))
    share = F.when(F.col("c").isNotNull(), F.col("n") * F.log10((F.col("c") + 1.0) / F.element_at(held, F.col("g") + 1))).otherwise(0.0)
    added = tail.join(model["counts"], "word", "left").groupBy("uid").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("more"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n") * F.log10(F.col("c") + 1.0)).otherwise(0.0)).alias("logs"),
        F.sum(F.element_at("logs", own + 1).cast("double") + share).alias("rest"))
    zero = F.lit(0.0)
    everything = float(np.log10(float(model["tokens"] + model["types"] + 1)))
    return scanned.drop("tail").join(added, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model["tokens"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("logs", zero) - F.col("n_tokens") * everything).alias("base_score"),
        (F.col("lm") + F.coalesce("rest", zero)).alias("score"))
