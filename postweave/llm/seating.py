"""Gibbs sampling of Chinese-restaurant seatings, for many restaurants at once.

A pair (restaurant, dish) has c customers, who sit at t tables of that dish. Chances depend on numbers of tables only, and with
the sizes of tables summed out a restaurant's seating has the weight

    prod_i (strength + discount * i), i < all tables  *  prod_dishes S(c, t) * chance^t

with S(c, t) the generalised Stirling numbers, S(c + 1, t) = (c - discount * t) S(c, t) + S(c, t - 1). The first product is
the mean of (discount * y)^tables over a gamma variable y of the restaurant. Given y its dishes are independent, each with the
weight S(c, t) * (discount * y * chance)^t. A step draws y and then t of all pairs, up to DRAWN customers from all values of t,
beyond by MOVES Metropolis moves; so all customers take part in it. S comes from its recursion up to EXACT customers. For more,
S(c, t) Gamma(t) discount^(t - 1) c^discount / Gamma(c) is read from row EXACT, as in the limit it depends on t / c^discount only.
"""

from __future__ import annotations

import math

import numpy as np

DRAWN, EXACT, MOVES = 64, 4096, 8
RUN = 1.1
# Cells of a table of chances that are made at once.
CELLS = 1 << 17
# Of the rows of Stirling numbers, those of so many customers and its multiples are kept for the next restaurants.
KEPT = 8
_kept: dict[float, dict[int, np.ndarray]] = {}


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log gamma(x), x >= 1."""
    x = np.asarray(x, np.float64)
    up = x + 8
    product = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5) * (x + 6) * (x + 7)
    return (up - 0.5) * np.log(up) - up + 0.5 * math.log(2 * math.pi) + 1 / (12 * up) - 1 / (360 * up**3) - np.log(product)


def log_stirling_rows(wanted: np.ndarray, discount: float) -> dict[int, np.ndarray]:
    """log S(c, t), t = 0 to c, of each c that is wanted.

    A worker keeps some rows up to EXACT of one discount, at most EXACT / KEPT of them, so that the recursion takes few steps to any other.
    """
    if discount not in _kept:
        _kept.clear()
        _kept[discount] = {0: np.zeros(1)}
    kept, rows = _kept[discount], {}
    c, row = 0, kept[0]
    for goal in sorted(set(wanted.tolist())):
        near = min(goal // KEPT * KEPT, max(kept))
        if near > c:
            c, row = near, kept[near]
        while c < goal:
            row = _next_row(row, c, discount)
            c += 1
            if c % KEPT == 0 and c <= EXACT:
                kept[c] = row
        rows[goal] = row
    return rows


def _next_row(row: np.ndarray, c: int, discount: float) -> np.ndarray:
    """The row of one customer more, from that of ``c``."""
    with np.errstate(divide="ignore"):
        stays = np.log(c - discount * np.arange(c + 1)) + row if c else np.full(1, -np.inf)
    return np.append(np.logaddexp(stays, np.append(-np.inf, row[:-1])), 0.0)


class Seating:
    """``tables`` of all pairs; ``chance`` is that of a pair's dish in the parent.

    ``strength`` is one number or one for each restaurant. ``tables`` takes up a seating where it was left.
    """

    def __init__(self, restaurant: np.ndarray, customers: np.ndarray, discount: float, strength, chance: np.ndarray, seed, tables: np.ndarray | None = None):
        self.rng = np.random.default_rng(seed)
        self.restaurant, self.customers = restaurant, customers.astype(np.int64)
        self.restaurants = int(restaurant.max()) + 1 if len(restaurant) else 0
        self.discount, self.strength = discount, np.broadcast_to(strength, max(self.restaurants, np.size(strength)))[: self.restaurants]
        self.tables = self._first(chance) if tables is None else tables

        sizes = np.unique(self.customers)
        rows = log_stirling_rows(np.unique(np.minimum(sizes, EXACT)), discount)
        few = np.flatnonzero((self.customers > 1) & (self.customers <= DRAWN))
        few = few[np.argsort(self.customers[few], kind="stable")]
        counts, first = np.unique(self.customers[few], return_index=True)
        self.few = [(rows[c][1:], pairs) for c, pairs in zip(counts.tolist(), np.split(few, first[1:]))]

        self.many = np.flatnonzero(self.customers > DRAWN)
        by_size = np.lexsort((-self.customers[self.many], restaurant[self.many]))
        self.largest = by_size[np.unique(restaurant[self.many][by_size], return_index=True)[1]]
        own = np.minimum(self.customers[self.many], EXACT)
        kept, at = np.unique(own, return_inverse=True)
        if len(kept) and kept[-1] == EXACT:
            t = np.arange(1, EXACT + 1)
            limit = rows[EXACT][1:] + _log_gamma(t) + (t - 1) * math.log(discount) + discount * math.log(EXACT) - math.lgamma(EXACT)
            self.limit = np.append(-math.lgamma(1 - discount), limit)
        self.flat = np.concatenate([np.zeros(0), *(rows[c] for c in kept.tolist())])
        self.begins = (np.cumsum(kept + 1) - (kept + 1))[at]
        self.above = self.customers[self.many] > EXACT
        self.step(chance)

    def _first(self, chance: np.ndarray) -> np.ndarray:
        """Tables after all customers came in, each pair's in runs of about a tenth of those that are there."""
        tables = np.ones(len(self.customers), np.int64)
        seated = tables
        for k in range(math.ceil(math.log(max(self.customers, default=1), RUN)) - 1, -1, -1):
            there = np.maximum(seated, np.round(self.customers / RUN**k).astype(np.int64))
            of_restaurant = np.bincount(self.restaurant, tables, self.restaurants)
            opens = (self.strength + self.discount * of_restaurant)[self.restaurant] * chance
            new = self.rng.binomial(there - seated, opens / (seated - self.discount * tables + opens))
            tables, seated = tables + new, there
        return tables

    def step(self, chance: np.ndarray) -> None:
        """Draw the tables of all pairs anew."""
        if not len(self.customers):
            return
        y = self.rng.gamma(self.strength / self.discount + self.tables_of_restaurants())
        opens = np.log(self.discount * y[self.restaurant] * np.maximum(chance, 1e-300))
        for row, pairs in self.few:
            for k in range(0, len(pairs), CELLS // len(row)):
                some = pairs[k : k + CELLS // len(row)]
                self.tables[some] = self._drawn(row, opens[some])
        if not len(self.many):
            return
        log_opens = opens[self.many]
        self._move(np.arange(len(self.many)), lambda t: t * log_opens)
        # The largest pair of each restaurant once more, with the restaurant's own weight in place of y.
        pairs = self.many[self.largest]
        rest = (self.strength / self.discount + self.tables_of_restaurants())[self.restaurant[pairs]] - self.tables[pairs]
        factor = np.log(self.discount * np.maximum(chance[pairs], 1e-300))
        self._move(self.largest, lambda t: _log_gamma(rest + t) + t * factor)

    def _drawn(self, row: np.ndarray, opens: np.ndarray) -> np.ndarray:
        weight = row + opens[:, None] * np.arange(1, len(row) + 1)
        weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
        at = (weight <= (self.rng.random(len(opens)) * weight[:, -1])[:, None]).sum(axis=1)
        return np.minimum(at, len(row) - 1) + 1

    def log_stirling(self, some: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """log S(c, t) of some of the pairs ``many``, for more than EXACT customers without a factor of c alone."""
        out, above = np.empty(len(tables)), self.above[some]
        out[~above] = self.flat[self.begins[some[~above]] + tables[~above]]
        if above.any():
            t, c = tables[above], self.customers[self.many[some[above]]]
            place = t * (EXACT / c) ** self.discount
            value = np.interp(place, np.arange(EXACT + 1), self.limit)
            out[above] = np.where(place <= EXACT, value - _log_gamma(t) - (t - 1) * math.log(self.discount), -np.inf)
        return out

    def _move(self, some: np.ndarray, others) -> None:
        """Metropolis moves of some of the pairs ``many`` by the weight S(c, t) * exp(others(t)).

        They are symmetric, by widths of all orders up to the greatest spread of t.
        """
        pairs = self.many[some]
        customers, now = self.customers[pairs], self.tables[pairs]
        widest = 0.5 * self.discount * np.log(customers)
        weight = self.log_stirling(some, now) + others(now)
        for _ in range(MOVES):
            width = 1 + np.exp(widest * self.rng.random(len(now))) * 2 * self.rng.random(len(now))
            to = now + np.where(self.rng.random(len(now)) < 0.5, -1, 1) * width.astype(np.int64)
            fits = (to >= 1) & (to <= customers)
            to = np.where(fits, to, now)
            its = self.log_stirling(some, to) + others(to)
            taken = fits & (np.log(np.maximum(self.rng.random(len(now)), 1e-300)) < its - weight)
            now, weight = np.where(taken, to, now), np.where(taken, its, weight)
        self.tables[pairs] = now

    @property
    def owner(self) -> np.ndarray:
        """The pair of each place of ``sizes``."""
        return np.repeat(np.arange(len(self.customers)), self.tables)

    @property
    def sizes(self) -> np.ndarray:
        """One seating with these numbers of tables: all but the first have one customer. Sizes are no part of the state."""
        out = np.ones(int(self.tables.sum()), np.int64)
        out[np.cumsum(self.tables) - self.tables] = self.customers - self.tables + 1
        return out

    def tables_of_restaurants(self) -> np.ndarray:
        return np.bincount(self.restaurant, self.tables, self.restaurants).astype(np.int64)
