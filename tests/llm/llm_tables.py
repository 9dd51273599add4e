"""Tables and plain versions that several tests share."""

import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a documents table with clashing extra columns."""

    def build(rows):
        full = [(i, t, "en", "src0", len(t or ""), "x", 1, "y", True) for i, t in rows]
        extra = ", node bigint, bucket string, score string, kept boolean"
        values = [(*r[:5], 1, r[5], r[7], r[8]) for r in full]
        return spark.createDataFrame(values, DOCUMENTS + extra)

    return build


def brute(rows, width, percent):
    """component of every row with an id, by comparing all pairs."""
    sets = {}
    for key, text in rows:
        words = (text or "").encode().lower().split()
        if key is None:
            continue
        grams = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
        sets[key] = grams or ({tuple(words)} if words else set())
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in keys}
