import pytest

from lexirank.transitions import DEFAULT_TRANSITIONS, parse_transition, parse_transitions


def test_list_is_sorted_and_distinct():
    assert [t.text for t in parse_transitions("3-4:3, 2:1,2:1")] == ["2:1", "3-4:3"]
    assert [t.text for t in parse_transitions(DEFAULT_TRANSITIONS)] == ["2:1", "3:2", "4:3"]


@pytest.mark.parametrize("text", ["2:1,2:2", "1-2:1,2-3:2", "", "2", "0:1", "5:5", "2-4:2", "1-2:3", "3:1", "2:6"])
def test_bad_lists(text):
    with pytest.raises(ValueError):
        parse_transitions(text)


@pytest.mark.parametrize("text,other,common,rare", [("2-3:3", 2, 2, 3), ("2-3:2", 3, 2, 3), ("4:4", 5, 4, 5), ("2:1", 2, 1, 2)])
def test_other_level(text, other, common, rare):
    t = parse_transition(text)
    assert (t.other, t.common, t.rare) == (other, common, rare)
