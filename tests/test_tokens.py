"""Token expressions."""

from wortfund.functions import tokens as K

TEXT = "Um 12 fuhr der Zug, um 14 der Bus: Zug und Bus fuhr um 12 leer."


def test_empty_text_has_no_keys(run):
    assert run(K.build_index_keys, ["", None, " .-"]) == [[], [], []]


def test_keys_of_a_text(run):
    (keys,) = run(K.build_index_keys, [TEXT])
    assert len(keys) == 16
    assert keys[:3] == ["um", "12", "fuhr"]
    (terms,) = run(K.distinct_terms, [TEXT])
    assert len(terms) == len(set(terms)) == 9
    assert {"um", "12", "leer"} <= set(terms)


def test_letters_and_digits_are_separate_runs(run):
    assert run(K.tokenize_plain, ["abc123 Ελλάδα-x_y ½ 12,5"]) == [
        ["abc", "123", "Ελλάδα", "x", "y", "½", "12", "5"]
    ]


def test_headings_and_template_markers_are_no_tokens(run):
    text = "== Kopf ==\na|TEMPLATE|b = c\n=Ende"
    assert run(K.tokenize_display, [text]) == [["a", "b", "c"]]
    assert run(K.drop_template_marker, ["a|TEMPLATE|b TEMPLATE"]) == ["a b TEMPLATE"]


def test_lower_case_is_taken_per_token(run):
    # A capital sigma at the end of a word becomes the final form.
    assert run(K.build_index_keys, ["ΟΔΟΣ ÄÖÜ SS"]) == [["οδος", "äöü", "ss"]]


def test_compound_keys(run):
    def keys(text):
        return K.compound_keys(K.tokenize_plain(text))

    assert run(keys, ["b a c", "a", "", "a a"]) == [["ab", "ac"], [], [], ["aa"]]


def test_texts_lowered_whole_have_the_same_keys(run):
    """Every character that may stand in one, between letters and between digits; and those that may not."""
    whole = [chr(c) for c in (*range(0x130), *range(0x2000, 0x2070))]
    texts = [" ".join(f"A{c}B 1{c}2" for c in whole)] + [f"A{c}B {c}" for c in ("İ", "Σ", "Ⱥ", "\U00010400", "ẞ")]
    each = run(lambda text: K.normalize_tokens(K.tokenize_display(text)), texts)
    assert run(K.build_index_keys, texts) == each
    assert each[0][:2] == ["a", "b"] and "aöb" in each[0]
