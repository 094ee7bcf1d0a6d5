"""Texts that the tests of corpus operators share."""

import random

import pytest


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, edited copies, shared passages, repeats, blanks and nulls."""
    draw = random.Random(5)
    names = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 7))) for _ in range(400)]

    def text(n):
        return draw.choice([" ", "\n", "\t "]).join(draw.choice(names) for _ in range(n))

    passage, long = text(40), text(30_000)
    rows = [(i, text(draw.randint(0, 120))) for i in range(60)]
    rows += [(60 + i, rows[i][1]) for i in range(8)]
    for i in range(25):
        own = rows[20][1].split() + text(30).split()[: i % 3]
        for _ in range(i % 5):
            own[draw.randrange(len(own))] = draw.choice(names)
        rows.append((100 + i, " ".join(own).upper() if i == 7 else " ".join(own)))
    rows += [(200 + i, f"{text(9)} {passage} {text(5)}") for i in range(12)]
    rows += [(220 + i, " ".join(["again"] * (5 + i))) for i in range(12)]
    rows += [(300, None), (301, ""), (302, " \n"), (303, "one"), (304, "one"), (305, long)]
    rows += [(306, f"x {long[:9000]}"), (-4, passage), (307, "a b c \x1cd")]
    return rows
