"""What the queries and their twins in SQL are given, besides the tables."""

from __future__ import annotations

#: A fixed ensemble: feature, threshold, value up to it, value above, weight of the tree.
STUMPS = [
    ("price", 906.0, 0.25, -0.25, 1.0),
    ("event_weekday", 4.0, -0.5, 0.25, 0.5),
    ("activity_count", 2.0, -0.25, 0.75, 0.5),
    ("price", 903.0, 0.5, -0.125, 0.25),
]

#: A label that the features tell: from this weekday on, or above this price, not both.
PLANTED_WEEKDAY, PLANTED_PRICE = 5, 905.0

#: The product whose events are looked up.
LOOKUP_PRODUCT = 42

#: Per cent of the rows that an approximate median may lie off the middle.
MEDIAN_ERROR = 2

#: Trials of a search: features, learning rate, least weight of a leaf, least gain.
TRIALS = [
    (("price",), 1.0, 1.0, 0.0),
    (("event_weekday",), 1.0, 1.0, 0.0),
    (("activity_count",), 1.0, 1.0, 0.0),
    (("price", "event_weekday", "activity_count"), 1.0, 1.0, 0.0),
    (("price", "event_weekday", "activity_count"), 0.3, 1.0, 0.0),
    (("event_weekday", "activity_count"), 0.5, 40.0, 0.0),
    (("price", "activity_count"), 1.0, 1.0, 1000000.0),
]
TRIAL_FEATURES = ("price", "event_weekday", "activity_count")
