import pytest

#: Texts with the awkward cases: null, empty, blanks only, one word, controls, other scripts, long.
AWKWARD = [None, "", " \n\t", "word", "A b", "tab\there\x0bvt", "nbsp here  em", "漢字 かな 😀 é́", "x\x1cy \x85z", "<|endoftext|> in <|startoftext|> text", "Don't   stop.\n\n  Now\r\nit's 12345!", "long " * 9000]


@pytest.fixture
def docs(frame):
    """Documents (doc_id, text) with columns whose names clash with inner ones."""

    def build(rows):
        full = [(i, t, "en", "s", 0, 7, "x", 0.5) for i, t in rows]
        return frame("doc_id long, text string, lang string, source string, n_chars long, key long, mark string, score double", *full)

    return build


def awkward_rows():
    rows = list(enumerate(AWKWARD))
    return [*rows, (3, "word"), (None, "word"), (None, None)]  # a repeated row, null ids
