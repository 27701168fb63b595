import random

import numpy as np
import pytest

from sparktab.llm.decontaminate import SeedIndex
from tests.llm.test_decontaminate import plain


@pytest.mark.parametrize("size,replaced", [(15, (4, 7)), (18, (9, 10, 11)), (20, (0, 9, 10, 11))])
def test_the_longest_stretch_counts(size, replaced):
    """A shorter run of equal words must not hide a longer stretch that meets the definition."""
    item = [f"t{i}" for i in range(size)]
    doc = ["x"] * 5 + [w if i not in replaced else "new" for i, w in enumerate(item)] + ["y"] * 5
    ((_, _, _, equal),) = SeedIndex([(1, item)]).matches(doc)
    assert equal == plain(doc, item) == size - len(replaced)


def test_a_laid_passage_equals_all_stretches():
    """Wherever a seed lays the passage at its shift, the result is that of comparing all stretches."""
    rng = random.Random(2)
    for _ in range(400):
        size = rng.randint(12, 40)
        item = [f"t{i}" for i in range(size)]
        gone = set(rng.sample(range(size), rng.randint(0, size // 4)))
        doc = ["x"] * 3 + [w if i not in gone else "new" for i, w in enumerate(item)] + ["y"] * 3
        index, found = SeedIndex([(1, item)]), {}
        index._lay(np.array([index.numbers.get(w, 0) for w in doc]), 0, 3, found)
        assert (found[0][0] if found else 0) == plain(doc, item), gone
