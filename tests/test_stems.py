"""The stems that the SQL side works out against the library's, on made-up words of every ending."""

import random

import duckdb
import pandas as pd

from pagewright.catalog.stem_sql import stems_sql
from pagewright.functions import stem


def test_stems_in_sql():
    rng = random.Random(1)
    past = ["eedly", "ingly", "edly", "eed", "ing", "ed"]
    plural = ["s", "sses", "ies", "ied", "us", "ss", "'s", "'"]
    endings = [*stem.STEP_2, *stem.STEP_3, *stem.STEP_4, *past, *plural, "e", "ll", "y"]
    words = {*stem.WHOLE_WORDS, *stem.KEPT_AFTER_PLURAL, *(w + "s" for w in stem.KEPT_AFTER_PLURAL)}
    for _ in range(30_000):
        start = rng.choice(["", "", "y", "'", *stem.LONG_PREFIXES])
        middle = "".join(rng.choices("aeiouybcdlmnrstwxy", k=rng.randint(0, 7)))
        words.add(start + middle + "".join(rng.choices(endings, k=rng.choice([0, 1, 1, 2]))) or "b")
    table = pd.DataFrame({"term": sorted(words)})
    con = duckdb.connect()
    con.register("words", table)
    found = dict(con.execute(f"WITH {stems_sql('words')} SELECT term, stem FROM stems").fetchall())
    assert found == {word: stem.stem_word(word) for word in words}
