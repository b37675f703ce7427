import tracemalloc

import numpy as np

from silverlode.llm import linking


def test_many_matches_are_looked_at_in_little_memory():
    """Two groups without a link between them whose sets share half their hashes: three million matches."""
    shared = np.arange(800)
    sets = [np.concatenate([shared, 1000 + 400 * group + np.arange(400)]) for group in (0, 1) for _ in range(60)]
    labels = np.repeat([0, 1], 60)
    tracemalloc.start()
    found = list(linking.spanning_links(labels, sets, (8, 10)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert not any(len(x) for x, _ in found) and peak < 80e6
    assert any(len(x) for x, _ in linking.spanning_links(labels, sets, (5, 10)))
