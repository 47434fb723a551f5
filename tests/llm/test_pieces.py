"""Where texts are cut: after every kind of white space, by tests that cost less than an expression over the whole text."""

import re
import sys
import time

from hangarlight.llm import subwords


def test_cuts_follow_no_white_space_of_any_kind():
    spaces = [c for c in map(chr, range(sys.maxunicode + 1)) if re.match(r"\s", c)] + [subwords.BLANK]
    assert subwords._SPACES == spaces
    for c in spaces:
        for text in (f"a{c} b c", f"é{c} b c", f"{c} b", f"a {c}b"):
            assert subwords.pieces(text) == re.split(rf" (?<=[^\s{subwords.BLANK}] )", text)


def test_texts_without_runs_are_searched_fast():
    text, other = "some words of a text " * 20_000, re.compile(rf"[\s{subwords.BLANK}] ")
    taken = []
    for find in (subwords._runs, other.search):
        start = time.process_time()
        assert not any(find(text) for _ in range(10))
        taken.append(time.process_time() - start)
    assert taken[0] < taken[1] / 1.5
