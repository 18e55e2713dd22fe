"""Very long parts of addresses."""

from histloom.llm import pii


def test_a_part_of_thousands_of_zeros_ends_no_query():
    anchors = pii.build_anchors()
    for zeros, found in (("0" * 5000, 1), ("0" * 5000 + "255", 1), ("0" * 5000 + "256", 0), ("9" * 5000, 0)):
        assert len(pii.find_spans(f"at {zeros}.1.1.1 end", anchors)["ip"]) == found


def test_a_house_number_is_taken_whole():
    anchors = pii.build_anchors()
    for size in range(40, 62):                     # the look back of 60 ends before, in and behind the number
        street = "M" + "a" * size
        text = f"at 12345 {street} Street"
        for a, b in pii.find_spans(text, anchors)["address"]:
            assert text[a:b] == f"12345 {street} Street"
