"""Small corpora for the operators' tests."""

import random

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def corpus(seed: int, n: int = 60):
    """Invented texts with exact copies, near copies, shared passages, nulls, empties and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(80)]

    def words(k):
        return [rng.choice(vocabulary) for _ in range(k)]

    passage = " ".join(words(40))
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.15:
            text = rng.choice(rows)[1]
        elif rows and kind < 0.4 and rows[-1][1]:
            w = rng.choice([r[1] for r in rows if r[1]]).split(" ")
            for _ in range(rng.randint(1, 3)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            text = " ".join(w)
        else:
            text = " ".join(words(rng.choice([1, 3, 5, 30, 80]))) + rng.choice(["", "\n", " \t"])
        if text and rng.random() < 0.2:
            text = text + " " + passage + rng.choice(["", " " + " ".join(words(5))])
        rows.append((i, text))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t"), (None, rows[0][1]), (3, rows[3][1]), (n + 3, "x" * 3000)]
    return rows
