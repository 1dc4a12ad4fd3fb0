"""Scores of texts under a Brown class-based bigram model.

Tokens are the words of a text and one end. Counts of all tokens come from all training rows. The UNITS - GROUPS - 1
most frequent words are units of their own; all other words are grouped into GROUPS units by their last bytes. Exchange
clustering moves one unit after the other into the class that raises the likelihood of the class bigrams most, until
nothing moves. That seeds the classes. In each of ROUNDS rounds, the neighbours of every training word are then counted
by class over all training rows, and every word but the most frequent ones, which stay where they are, goes to the class
that raises the likelihood most by itself. As words go at the same time, a round that lowers the likelihood is undone
and is the last. Words without training rows have the class of their last bytes. A token has the probability

    LAMBDA * P(class | class before) * (c + 1) / (N_class + V_class + 1)  +  (1 - LAMBDA) * (c + 1) / (N + V + 1)

with its count c, and the tokens N and distinct tokens V of the class and of all training rows; class transitions are
smoothed by class frequencies. As c + 1 is a factor of both terms, the sum of log10(c + 1) is shared with the add-one
unigram score, and only the rest depends on the context. Counts and classes of up to HEAD words are looked up in a table
sent to the tasks; those of all others are joined.

Null text is empty: one end. Every row is scored on its own, repeated or not. Null ids are trained on and scored. Extra
columns are ignored. Without training rows every token has probability 1 / 1.
"""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import fold, prepare, stored
from .words import Words, mix, words

UNITS, GROUPS, CLASSES = 1024, 511, 48
HEAD = 1 << 20
#: Rounds in which all words choose their class.
ROUNDS = 2
LAMBDA = 0.95
#: Weight of the class frequencies in a transition, in tokens.
PRIOR = 20.0
FOLDS, HELD_OUT = 7, 2
END = 1
#: Distinct words that a task holds before it passes their counts on.
HOLD = 600_000
_U = np.uint64


def endings(w: Words) -> np.ndarray:
    """Group of every word by its last three bytes."""
    out = np.zeros(len(w.end), np.uint64)
    for k in (1, 2, 3):
        at = w.end - k
        byte = np.where(at >= w.start, w.data[np.maximum(at, 0)], 0)
        byte = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
        out = out * _U(256) + byte.astype(_U)
    return (mix(out) % _U(GROUPS)).astype(np.int32)


def grouped(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal numbers stand together, and where in it each run of them begins.

    Places are sorted along in the last bits of the numbers, which is several times faster than an order of whole ones.
    Different numbers that agree in all other bits may mix, so a number may rarely have more runs than one.
    """
    bits = _U(len(number).bit_length())
    order = (np.sort((number >> bits << bits) | np.arange(len(number), dtype=_U)) & ((_U(1) << bits) - _U(1))).astype(np.int64)
    x = number[order]
    return order, np.flatnonzero(np.concatenate((np.ones(min(len(x), 1), bool), x[1:] != x[:-1])))


def _count(batches):
    """Counts of (word, group), flushed whenever a task holds many; a word may have more rows than one."""
    keys, counts, groups, held = [], [], [], 0

    def merged():
        k, n, g = np.concatenate(keys), np.concatenate(counts), np.concatenate(groups)
        order, first = grouped(k)
        return k[order[first]], np.add.reduceat(n[order], first), g[order[first]]

    def rows(k, n, g):
        for at in range(0, len(k), 1 << 15):
            part = slice(at, at + (1 << 15))
            yield pa.RecordBatch.from_arrays([pa.array(k[part].view(np.int64)), pa.array(g[part]), pa.array(n[part])], ["word", "ending", "n"])

    for batch in batches:
        w = words(batch.column("text"))
        order, first = grouped(w.number)
        one = order[first]
        keys += [w.number[one], np.array([END], _U)]
        counts += [np.diff(np.append(first, len(order))), np.array([batch.num_rows], np.int64)]
        groups += [endings(w._replace(start=w.start[one], end=w.end[one])), np.array([-1], np.int32)]
        held += len(one) + 1
        if held > 2 * HOLD:
            k, n, g = merged()
            if len(k) > HOLD:
                yield from rows(k, n, g)
                keys, counts, groups, held = [], [], [], 0
            else:
                keys, counts, groups, held = [k], [n], [g], len(k)
    if keys:
        yield from rows(*merged())


def _bigrams(units):
    """Counts of pairs of neighbouring units, from stored places; ``units`` has those of the head and of the end."""

    def count(batches):
        of, total, held, n_held = units.value, np.zeros(UNITS * UNITS, np.int64), [], 0
        for place in _stored_places(batches):
            unit = np.where(place >= 0, of[np.maximum(place, 0)], np.int32(UNITS - GROUPS - 1) - place)
            held.append(unit[:-1] * np.int32(UNITS) + unit[1:])
            n_held += len(held[-1])
            if n_held > HOLD:
                total += np.bincount(np.concatenate(held), minlength=UNITS * UNITS)
                held, n_held = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=UNITS * UNITS)
        found = np.flatnonzero(total)
        for at in range(0, len(found), 1 << 15):
            part = found[at : at + (1 << 15)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], ["pair", "n"])

    return count


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int, rounds: int = 30) -> np.ndarray:
    """Class of every unit, given the counts of pairs of neighbouring units, by exchange clustering.

    The likelihood is the sum of n log n over class bigrams minus that over the classes on either side.
    """
    n = len(pairs)
    of = np.empty(n, int)
    of[np.argsort(-(pairs.sum(0) + pairs.sum(1)), kind="stable")] = np.arange(n) % classes
    one = np.eye(classes)
    right, left = pairs @ one[of], pairs.T @ one[of]  # by unit: what follows it and what precedes it, by class
    table = one[of].T @ right
    for _ in range(rounds):
        moved = 0
        for u in range(n):
            own, r, c, s = of[u], right[u].copy(), left[u].copy(), pairs[u, u]
            if not r.sum() and not c.sum():
                continue
            r[own] -= s
            c[own] -= s
            table[own] -= r
            table[:, own] -= c
            table[own, own] -= s
            rows, columns, corner = table.sum(1), table.sum(0), np.diag(table)
            fx = _xlogx(table)
            new_rows, new_columns = table + r, table + c[:, None]
            gain = (_xlogx(new_rows) - fx).sum(1) + (_xlogx(new_columns) - fx).sum(0)
            both = corner + r + c + s
            gain += _xlogx(both) - _xlogx(corner + r) - _xlogx(corner + c) + np.diag(fx)
            gain -= _xlogx(rows + r.sum() + s) - _xlogx(rows) + _xlogx(columns + c.sum() + s) - _xlogx(columns)
            best = int(gain.argmax())
            if gain[best] <= gain[own] + 1e-9:
                best = own
            table[best] += r
            table[:, best] += c
            table[best, best] += s
            if best != own:
                of[u] = best
                moved += 1
                right[:, own] -= pairs[:, u]
                right[:, best] += pairs[:, u]
                left[:, own] -= pairs[u]
                left[:, best] += pairs[u]
        if not moved:
            break
    return of


def best_classes(table: np.ndarray, own: np.ndarray, bound: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For every word the class that raises the likelihood most, all other words staying where they are.

    ``table`` counts class bigrams with the words in their classes ``own``. Word i has the neighbours
    ``bound[i]:bound[i + 1]``: ``n`` times one of class ``code`` after it, of class ``code`` - classes before it, or, with
    the last code, itself. Codes of a word are distinct.
    """
    k, m = len(table), len(own)
    word, i = np.repeat(np.arange(m), np.diff(bound)), np.arange(m)
    dense = np.zeros((m, 2 * k + 1))
    dense[word, code] = n
    after, before, same = dense[:, :k], dense[:, k : 2 * k], dense[:, 2 * k]
    raised = np.zeros((len(code), k))
    for side, cells, others in ((code < k, table.T, before), ((code >= k) & (code < 2 * k), table, after)):
        w, x, j = word[side], n[side].astype(float), code[side] % k
        rest = cells[j].copy()  # cells of the neighbours' class with every class, less those of the word itself
        rest[np.arange(len(w)), own[w]] -= x
        both = np.flatnonzero(j == own[w])
        rest[both] -= others[w[both]]
        rest[both, own[w[both]]] -= same[w[both]]
        raised[side] = _xlogx(rest + x[:, None]) - _xlogx(rest)
    gain = np.add.reduceat(raised, bound[:-1], axis=0)
    corner = np.tile(np.diag(table), (m, 1))
    corner[i, own] -= after[i, own] + before[i, own] + same
    gain += _xlogx(corner + after + before + same[:, None]) - _xlogx(corner + after) - _xlogx(corner + before) + _xlogx(corner)
    for sums, side in ((table.sum(1), after), (table.sum(0), before)):
        tokens = side.sum(1) + same
        rest = np.tile(sums, (m, 1))
        rest[i, own] -= tokens
        gain -= _xlogx(rest + tokens[:, None]) - _xlogx(rest)
    best = gain.argmax(1)
    return np.where(gain[i, best] > gain[i, own] + 1e-9, best, own)


def likelihood(table: np.ndarray) -> float:
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def _places_in(head: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Places of words in the sorted ``head``, -1 for others."""
    if not len(head):
        return np.full(len(number), -1)
    at = np.minimum(np.searchsorted(head, number), len(head) - 1)
    return np.where(head[at] == number, at, -1)


def finder(head: np.ndarray, steps: int = 6):
    """``_places_in`` for a long ``head`` that is asked many times: a function of numbers to places (32 bits).

    The first bits of a number tell where to begin. Numbers are spread evenly, so it stands there or a few places
    on; after ``steps`` places the rest is searched for.
    """
    shift, size = _U(63 - len(head).bit_length()), len(head)
    begin = np.zeros(1 << (64 - int(shift)), np.int32)
    np.cumsum(np.bincount((head >> shift).astype(np.int64), minlength=len(begin))[:-1], out=begin[1:])
    ended = np.append(head, ~_U(0))

    def places(number: np.ndarray) -> np.ndarray:
        at = begin[number >> shift]
        there = ended[at]
        out = np.where(there == number, at, np.int32(-1))
        left = np.flatnonzero(there < number)
        at = at[left]
        for _ in range(steps):
            if not len(left):
                break
            at = at + np.int32(1)
            wanted, there = number[left], ended[at]
            hit, on = there == wanted, there < wanted
            out[left[hit]] = at[hit]
            left, at = left[on], at[on]
        out[left] = _places_in(head, number[left])
        out[out == size] = -1
        return out

    return places


def classes_of(w: Words, m: dict, find) -> tuple[np.ndarray, np.ndarray]:
    """Class of every word, and its place in the head; words outside of the head have the class of their last bytes."""
    place = find(w.number)
    far = place < 0
    of = np.zeros(len(place), np.int64) if far.all() else m["classes"][place]
    if far.any():
        of[far] = m["group"][endings(w._replace(start=w.start[far], end=w.end[far]))]
    return of, place


#: A kind of neighbour of a word, and how often.
ENTRY = np.dtype([("code", "<u2"), ("n", "<u4")])
SUMMED = np.dtype([("code", "<u2"), ("n", "<i8")])
#: Rows of a shuffled table that a task looks at together.
ROWS = 1 << 14


def _packed(word: np.ndarray, bound: np.ndarray, code: np.ndarray, n: np.ndarray):
    """Batches (word, kinds) of the entries ``bound[i]:bound[i + 1]`` of every word."""
    entries = np.empty(len(code), ENTRY)
    entries["code"], entries["n"] = code, n
    for at in range(0, len(word), 1 << 15):
        part = bound[at : at + (1 << 15) + 1]
        offsets = ((part - part[0]) * ENTRY.itemsize).astype(np.int32)
        kinds = pa.Array.from_buffers(pa.binary(), len(part) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(entries[part[0] : part[-1]].tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(word[at : at + (1 << 15)]), kinds], ["word", "kinds"])


def _fixed(m: dict) -> tuple[np.ndarray, np.ndarray]:
    """Words that keep their class, and a flag for each place in the head and for the end."""
    words_ = np.append(m["frequent"], _U(END))
    return np.sort(words_), np.append(np.isin(m["head"], m["frequent"]), True)


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of rows by ``keys``, the first most important, and where in it each distinct row begins."""
    order = np.lexsort(keys[::-1])
    first = np.zeros(len(order), bool)
    first[:1] = True
    for key in keys:
        key = key[order]
        first[1:] |= key[1:] != key[:-1]
    return order, np.flatnonzero(first)


def _near(model):
    """Neighbours in the head, and ends, of the words in the head that choose a class: (word, kinds)."""

    def count(batches):
        m = model.value
        k, names, held, n_held = m["k"], np.append(m["head"], _U(END)).view(np.int64), [], 0
        of, free = np.append(m["classes"], m["end_class"]), ~_fixed(m)[1]
        width = 2 * k + 1
        kind = np.int32 if len(of) * width < 1 << 31 else np.int64  # short keys sort faster
        of = of.astype(kind)

        def merged():
            keys, n = np.concatenate([x[0] for x in held]), np.concatenate([x[1] for x in held])
            order, first = grouped(keys.astype(_U) << _U(24))  # keys below 2**40, so none agree in the bits that are sorted
            return keys[order[first]], np.add.reduceat(n[order], first)

        def rows(keys, n):
            place = keys // width
            first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            return _packed(names[place[first]], np.append(first, len(keys)), keys % width, n)

        for a, b in _near_pairs(batches):
            a, b = a.astype(kind), b.astype(kind)
            same = a == b
            after, before = a * width + np.where(same, kind(2 * k), of[b]), b * width + (of[a] + kind(k))
            keys = np.sort(np.concatenate((after[free[a]], before[free[b] & ~same])))
            if not len(keys):
                continue
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            held.append((keys[first], np.diff(np.append(first, len(keys)))))
            n_held += len(first)
            if n_held > 2 * HOLD:
                keys, n = merged()
                held, n_held = [(keys, n)], len(keys)
                if n_held > HOLD:
                    yield from rows(keys, n)
                    held, n_held = [], 0
        if held:
            yield from rows(*merged())

    return count


def _cut_once(head):
    """Pairs of neighbours with a word outside of the head, as numbers and places, and the places of all words.

    A row has either a pair or, in ``places``, the places of all words and ends of a batch of texts. An end has the
    last place; outside of the head a word has -1 in pairs and -1 less its group in ``places``.
    """

    def found(batches):
        find, size = finder(head.value), np.int32(len(head.value))
        for batch in batches:
            w = words(batch.column("text"))
            place = find(w.number)
            out = np.flatnonzero(place < 0)
            place[out] = -1 - endings(w._replace(start=w.start[out], end=w.end[out]))
            b = np.insert(place, w.bound[1:], size)
            a = np.concatenate(([size], b[:-1]))
            far = np.flatnonzero((a < 0) | (b < 0))
            if len(far):
                second = np.insert(w.number, w.bound[1:], _U(END)).view(np.int64)
                first = np.concatenate(([END], second[:-1]))
            for at in range(0, len(far), 1 << 15):
                part = far[at : at + (1 << 15)]
                columns = [pa.array(first[part]), pa.array(second[part]), pa.array(np.maximum(a[part], -1)), pa.array(np.maximum(b[part], -1))]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(part), pa.binary())], PAIR)
            for at in range(0, len(b), PLACES):  # a part begins with the last place of the part before, or an end
                part = b[max(at - 1, 0) : at + PLACES] if at else np.concatenate((a[:1], b[:PLACES]))
                none = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())]
                yield pa.RecordBatch.from_arrays([*none, pa.array([part.astype("<i4").tobytes()], pa.binary())], PAIR)

    return found


PAIR = ["a", "b", "place_a", "place_b", "places"]
#: Places in one row.
PLACES = 1 << 17


def _stored_places(batches):
    for batch in batches:
        for row in batch.column("places"):
            yield np.frombuffer(row.as_buffer(), "<i4")


def _near_pairs(batches):
    """Places of the first and the second word of the pairs in the head, from stored places."""
    for place in _stored_places(batches):
        a, b = place[:-1], place[1:]
        near = (a >= 0) & (b >= 0)
        yield a[near], b[near]


def _classes(batch, m: dict) -> list[np.ndarray]:
    """Classes of the first and the second word of joined pairs."""
    of, out = np.append(m["classes"], m["end_class"]), []
    for side in "ab":
        place = batch.column(f"place_{side}").to_numpy()
        out.append(np.where(place >= 0, of[place], batch.column(f"class_{side}").to_numpy()))
    return out


def _far_kinds(model):
    """(word, kinds) of those words of the joined pairs that choose a class, added up as far as a task holds them."""

    def kinds(batches):
        m = model.value
        k, held, n_held, fixed = m["k"], [], 0, _fixed(m)[0]

        def rows():
            word, code = (np.concatenate(x) for x in zip(*held))
            order, first = _runs(word, code)
            word, code, n = word[order[first]], code[order[first]], np.diff(np.append(first, len(order)))
            new = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            return _packed(word[new], np.append(new, len(word)), code, n)

        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            class_a, class_b = _classes(batch, m)
            same = a == b
            word = np.concatenate((a, b[~same]))
            code = np.concatenate((np.where(same, 2 * k, class_b), k + class_a[~same])).astype(np.int16)
            free = _places_in(fixed, word.view(_U)) < 0
            held.append((word[free], code[free]))
            n_held += int(free.sum())
            if n_held > HOLD:
                yield from rows()
                held, n_held = [], 0
        if n_held:
            yield from rows()

    return kinds


def _own_kinds(k: int):
    """The class of a word and one, as if that were the count of one more kind."""

    def kinds(batches):
        for batch in batches:
            word = batch.column("word").to_numpy()
            yield from _packed(word, np.arange(len(word) + 1), np.full(len(word), 2 * k + 1), batch.column("class").to_numpy() + 1)

    return kinds


def _table(model, joined: bool):
    """Class bigrams: of pairs in the head from stored places, of others from joined pairs."""

    def count(batches):
        m = model.value
        k = m["k"]
        total, of = np.zeros(k * k, np.int64), np.append(m["classes"], m["end_class"])
        pairs = (_classes(x, m) for x in batches) if joined else ((of[a], of[b]) for a, b in _near_pairs(batches))
        for a, b in pairs:
            total += np.bincount(a * k + b, minlength=k * k)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["slot", "n"])

    return count


def _choose(model):
    """Classes of words from their kinds of neighbours, sorted by word."""

    def choose(batches):
        m = model.value
        k = m["k"]
        width = 2 * k + 2

        def chosen(word, size, entries):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            of = np.repeat(np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word)))), size)
            word = word[first].view(_U)
            is_class = entries["code"] == width - 1
            place = _places_in(m["head"], word)
            own = m["classes"][place].copy() if len(m["head"]) else np.zeros(len(word), np.int64)
            own[of[is_class]] = entries["n"][is_class] - 1
            own[word == END] = m["end_class"]
            keys, n = (of * width + entries["code"])[~is_class], entries["n"][~is_class]
            total = np.bincount(keys, n, len(word) * width).astype(np.int64)
            keys = np.flatnonzero(total)
            of, n, code = keys // width, total[keys], keys % width
            new = best_classes(m["table"], own, np.searchsorted(of, np.arange(len(word) + 1)), code, n)
            new = np.where((_places_in(m["frequent"], word) >= 0) | (word == END), own, new)
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(place.astype(np.int32)), pa.array(new.astype(np.int32))], ["word", "place", "class"])

        def summed(entries):
            """The kinds of one word, each once: a word of any frequency takes as much room as there are kinds."""
            n = np.zeros(width, np.int64)
            np.add.at(n, entries["code"], entries["n"])
            out = np.empty(np.count_nonzero(n), SUMMED)
            out["code"] = np.flatnonzero(n)
            out["n"] = n[out["code"]]
            return out

        held, n_held = [], 0
        for batch in batches:
            column = batch.column("kinds")
            _, offsets, data = column.buffers()
            offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
            if not len(column):
                continue
            entries = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(ENTRY).astype(SUMMED)
            held.append((batch.column("word").to_numpy(), np.diff(offsets) // ENTRY.itemsize, entries))
            n_held += len(column)
            if n_held >= ROWS:
                word, size, entries = (np.concatenate(x) for x in zip(*held))
                cut = int(np.searchsorted(word, word[-1]))  # the last word may go on
                if cut:
                    at = int(size[:cut].sum())
                    yield chosen(word[:cut], size[:cut], entries[:at])
                    word, size, entries = word[cut:], size[cut:], entries[at:]
                entries = summed(entries)
                held, n_held = [(word[:1], np.array([len(entries)]), entries)], 1
        if held:
            yield chosen(*(np.concatenate(x) for x in zip(*held)))

    return choose


def _joined(pairs: DataFrame, far: DataFrame) -> DataFrame:
    """Pairs with the classes of the words outside of the head, which are rare; all others are not joined by."""
    a, b = (far.select(F.col("word").alias(x), F.col("class").alias(f"class_{x}")) for x in "ab")
    sides = ["a", "b", "place_a", "place_b", "class_a", "class_b"]
    first = pairs.where("place_a < 0 and place_b >= 0").join(a, "a").withColumn("class_b", F.lit(-1))
    second = pairs.where("place_a >= 0 and place_b < 0").join(b, "b").withColumn("class_a", F.lit(-1))
    both = pairs.where("place_a < 0 and place_b < 0").join(a, "a").join(b, "b")
    return first.select(*sides).union(second.select(*sides)).union(both.select(*sides))


def cluster(cut: DataFrame, model: dict, far: DataFrame | None, rounds: int = ROUNDS):
    """The model with the classes of all words, the classes (word, class) of those outside of the head, and their bigrams.

    ``cut`` has the pairs and places of the training texts (``_cut_once``), ``model`` the first classes of the words in
    the head, ``far`` those of all others, if there are any.
    """
    with _long_batches(cut.sparkSession):
        return _rounds(cut.where("places is null").drop("places"), _places_of(cut), model, far, rounds)


def _places_of(cut: DataFrame) -> DataFrame:
    return cut.where("places is not null").select("places")


@contextmanager
def _long_batches(spark, rows: int = ROWS):
    """Tables of a few numbers a row go through tasks in longer batches than texts do."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _rounds(pairs: DataFrame, near: DataFrame, model: dict, far: DataFrame | None, rounds: int):
    spark, k, kept, used = pairs.sparkSession, model["k"], None, []

    def ship(value: dict):
        used.append(spark.sparkContext.broadcast(value))
        return used[-1]

    for at in range(rounds + 1):
        shipped = ship(model)
        sums = near.mapInArrow(_table(shipped, False), "slot int, n long")
        if far is not None:
            joined = stored(_joined(pairs, far), "joined")
            sums = sums.union(joined.mapInArrow(_table(shipped, True), "slot int, n long"))
        sums = sums.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        table = np.zeros(k * k)
        table[sums["slot"].to_numpy()] = sums["n"].to_numpy()
        table = table.reshape(k, k)
        if kept is not None and likelihood(table) <= likelihood(kept[2]):
            break
        kept = model, far, table
        if at == rounds:
            break
        shipped = ship(model | {"table": table})
        kinds = near.mapInArrow(_near(shipped), "word long, kinds binary")
        if far is not None:
            kinds = kinds.union(joined.mapInArrow(_far_kinds(shipped), "word long, kinds binary")).union(far.mapInArrow(_own_kinds(k), "word long, kinds binary"))
        sorted_ = kinds.repartition("word").sortWithinPartitions("word")
        chosen = stored(sorted_.mapInArrow(_choose(shipped), "word long, place int, class int"), "chosen")
        top = chosen.where("place >= 0").select("place", "class").toArrow()  # the head at most
        classes = model["classes"].copy()
        classes[top["place"].to_numpy()] = top["class"].to_numpy()
        model = model | {"classes": classes}
        if far is not None:
            far = chosen.where((F.col("place") < 0) & (F.col("word") != END)).select("word", "class")
        while used:
            used.pop().destroy()
    model, far, table = kept
    types = np.bincount(model["classes"], minlength=k).astype(float)
    for row in [] if far is None else far.groupBy("class").count().collect():
        types[row["class"]] += row["count"]
    types[model["end_class"]] += float(table.sum() > 0)
    return model, far, table, types


def _joined_context(model):
    """What the context of pairs gains by the joined classes."""

    def gain(batches):
        c = model.value["context"]
        for batch in batches:
            a, b, new_a, new_b, times = (batch.column(x).to_numpy() for x in ("ca", "cb", "new_a", "new_b", "times"))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array((c[new_a, new_b] - c[a, b]) * times)], ["row", "gain"])

    return gain


def _open_pairs(w: Words, of: np.ndarray, place: np.ndarray, m: dict) -> pa.ListArray:
    """By text the pairs of neighbours with a word outside of the head; ``a`` and ``b`` are null inside of it."""
    size = len(m["head"])
    number = np.insert(w.number, w.bound[1:], _U(END)).view(np.int64)
    of, place = np.insert(of, w.bound[1:], m["end_class"]), np.insert(place, w.bound[1:], size)
    text = np.repeat(np.arange(len(w.bound) - 1), np.diff(w.bound) + 1)
    last = [np.concatenate(([x], y[:-1])) for x, y in ((END, number), (m["end_class"], of), (size, place))]
    open_ = (place < 0) | (last[2] < 0)
    if not m["far"] or not open_.any():
        table, times = np.zeros((0, 7), np.int64), np.zeros(0, np.int64)
    else:
        table = np.stack([x[open_] for x in (text, last[0], number, last[1], of, (last[2] >= 0).astype(np.int64), (place >= 0).astype(np.int64))], 1)
        order, first_ = _runs(table[:, 0], table[:, 1], table[:, 2])  # the other columns go with the two words
        table, times = table[order[first_]], np.diff(np.append(first_, len(order)))
    flat = pa.StructArray.from_arrays(
        [
            pa.array(table[:, 1], mask=table[:, 5] > 0), pa.array(table[:, 2], mask=table[:, 6] > 0),
            pa.array(table[:, 3].astype(np.int32)), pa.array(table[:, 4].astype(np.int32)), pa.array(times.astype(np.int64)),
        ],
        ["a", "b", "ca", "cb", "times"],
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(table[:, 0], np.arange(len(w.bound))).astype(np.int32)), flat)


def _scorer(model):
    def score(batches):
        m = model.value
        end_log, find = float(np.log10(m["end"] + 1)), finder(m["head"])
        for batch in batches:
            w = words(batch.column("text"))
            of, place = classes_of(w, m, find)
            row, after = np.insert(of, w.bound[1:], m["end_class"]), w.bound[1:] + np.arange(1, len(w.bound))
            context = np.concatenate(([0.0], np.cumsum(m["context"][np.concatenate(([m["end_class"]], row[:-1])), row])))
            edge = np.concatenate(([0], after))
            logs, known = m["logs"], place >= 0
            gain = np.concatenate(([0.0], np.cumsum(np.where(known, logs[place] if len(logs) else 0.0, 0.0))))
            seen = np.concatenate(([0], np.cumsum(known)))
            size = np.diff(w.bound)
            text, number = np.repeat(np.arange(len(size)), size)[~known], w.number[~known]
            order, first = _runs(text, number)
            places = pa.array(np.searchsorted(text[order[first]], np.arange(len(w.bound))).astype(np.int32))
            flat = number[order[first]].view(np.int64), np.diff(np.append(first, len(order)))
            arrays = [
                batch.column("doc_id"),
                pa.array(size + 1),
                pa.array(seen[w.bound[1:]] - seen[w.bound[:-1]] + int(m["end"] > 0)),
                pa.array(gain[w.bound[1:]] - gain[w.bound[:-1]] + end_log),
                pa.array(context[edge[1:]] - context[edge[:-1]]),
                pa.ListArray.from_arrays(places, pa.array(flat[0], pa.int64())),
                pa.ListArray.from_arrays(places, pa.array(flat[1], pa.int64())),
                _open_pairs(w, of, place, m),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "n_known", "logs", "context", "words", "times", "open"])

    return score


def scores(docs: DataFrame, classes: int = CLASSES, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    train = docs.where(~held_out).select("text")

    counted = train.mapInArrow(_count, "word long, ending int, n long").groupBy("word").agg(F.sum("n").alias("n"), F.first("ending").alias("ending"))
    counts = stored(counted, "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    by_count = counts.groupBy("n").agg(F.count("*").alias("words")).toArrow().to_pandas().sort_values("n", ascending=False)
    fits = by_count[by_count["words"].cumsum() <= head]
    cut = int(fits["n"].min()) if len(fits) else 1 << 62
    top = counts.where(F.col("n") >= cut).toArrow()  # ``head`` rows at most
    word, n, ending = (top[c].to_numpy() for c in ("word", "n", "ending"))
    real = ending >= 0
    order = np.lexsort((word, -n))
    order = order[real[order]]
    frequent = np.sort(word[order[: UNITS - GROUPS - 1]].view(_U))
    end = counts.where(F.col("ending") < 0).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    by_word = np.argsort(word.view(_U), kind="stable")
    by_word = by_word[real[by_word]]
    known = word.view(_U)[by_word]
    shipped = spark.sparkContext.broadcast(known)
    cut_texts = stored(train.mapInArrow(_cut_once(shipped), "a long, b long, place_a int, place_b int, places binary"), "pairs")
    shipped.destroy()

    units = np.append(ending[by_word] + (UNITS - GROUPS), 0).astype(np.int32)
    units[np.searchsorted(known, frequent)] = np.arange(1, len(frequent) + 1)
    shipped = spark.sparkContext.broadcast(units)
    pairs = _places_of(cut_texts).mapInArrow(_bigrams(shipped), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(UNITS * UNITS)
    table[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()
    table = table.reshape(UNITS, UNITS)
    of = exchange(table, classes)

    group = of[UNITS - GROUPS :]
    first = group[ending[by_word]]
    first[np.searchsorted(known, frequent)] = of[1 : len(frequent) + 1]
    model = {"k": classes, "head": known, "classes": first, "group": group, "end_class": int(of[0]), "frequent": frequent}
    far = None
    if distinct > len(word):
        own = F.get(F.array(*(F.lit(int(x)) for x in group)), F.col("ending"))
        far = counts.where((F.col("n") < cut) & (F.col("ending") >= 0)).select("word", own.cast("int").alias("class"))
    model, far, moves, class_types = cluster(cut_texts, model, far)

    class_tokens = moves.sum(0)  # every token is the second of one pair
    overall = class_tokens / max(moves.sum(), 1)
    step = (moves + PRIOR * overall) / (moves.sum(1, keepdims=True) + PRIOR)
    context = np.log10(LAMBDA * step / (class_tokens + class_types + 1) + (1 - LAMBDA) / (total + distinct + 1))
    model |= {"context": context, "end": end, "logs": np.log10(n[by_word] + 1.0), "far": far is not None}
    model = spark.sparkContext.broadcast(model)

    schema = "doc_id long, n_tokens long, n_known long, logs double, context double, words array<long>, times array<long>, "
    schema += "open array<struct<a: long, b: long, ca: int, cb: int, times: long>>"
    scored = stored(docs.mapInArrow(_scorer(model), schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("t")).select("row", "t.words", "t.times")
    rare = (
        tail.join(counts.where(F.col("n") < cut).select(F.col("word").alias("words"), "n"), "words").groupBy("row")
        .agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"))
    )
    context = F.col("context")
    scored_rows = scored.drop("words", "times", "open").join(rare, "row", "left")
    if far is not None:
        pairs = scored.select("row", F.explode("open").alias("p")).select("row", "p.*")
        alone = pairs.where("a is null or b is null").withColumn("word", F.coalesce("a", "b")).join(far, "word")
        alone = alone.select("row", "ca", "cb", F.when(F.col("a").isNull(), F.col("ca")).otherwise(F.col("class")).alias("new_a"),
                             F.when(F.col("b").isNull(), F.col("cb")).otherwise(F.col("class")).alias("new_b"), "times")
        both = pairs.where("a is not null and b is not null")
        for side in "ab":
            both = both.join(far.select(F.col("word").alias(side), F.col("class").alias(f"new_{side}")), side, "left")
        both = both.select("row", "ca", "cb", F.coalesce("new_a", "ca").alias("new_a"), F.coalesce("new_b", "cb").alias("new_b"), "times")
        with _long_batches(spark):
            gains = alone.union(both).mapInArrow(_joined_context(model), "row long, gain double").groupBy("row").agg(F.sum("gain").alias("gain"))
            gains = stored(gains, "gains", narrow=True)
        scored_rows = scored_rows.join(gains, "row", "left")
        context = context + F.coalesce("gain", F.lit(0.0))
    logs = F.col("logs") + F.coalesce("more", F.lit(0.0))
    return scored_rows.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(total + distinct + 1)))).alias("base_score"), (logs + context).alias("score"),
    )
