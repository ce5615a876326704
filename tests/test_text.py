import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexirank.functions import responses
from lexirank.functions.repair import balanced_blocks, parse_content, repair_json, salvage_objects

JSON = st.recursive(st.none() | st.booleans() | st.integers(-99, 99) | st.text(max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=4), x, max_size=3), max_leaves=8)


@given(JSON.filter(lambda x: isinstance(x, (dict, list))))
@settings(max_examples=200, deadline=None)
def test_sound_json_is_unchanged_in_value(value):
    text = json.dumps(value)
    assert json.loads(repair_json(text)) == value
    assert parse_content(text)[1] == "plain"


@given(JSON.filter(lambda x: isinstance(x, (dict, list))))
@settings(max_examples=100, deadline=None)
def test_missing_closers_come_back(value):
    text = json.dumps([value, 1])
    while text.endswith(("]", "}")):
        text = text[:-1]
    assert json.loads(repair_json(text))[0] == value


@pytest.mark.parametrize(
    "broken,sound",
    [("[1., 2]", "[1.0, 2]"), ('{"a": 1, // x\n"b": 2}', '{"a": 1,\n"b": 2}'), ("[1,,2,]", "[1,2]"), ('{"a": "x', '{"a": "x"}'), ('["// no"]', '["// no"]'), ('["a\\', '["a"]'), ("[1, ", "[1]")],
)
def test_repairs(broken, sound):
    assert json.loads(repair_json(broken)) == json.loads(sound)


def test_blocks_and_salvage():
    text = 'well: [{"a": "]"}] and {"b": 1}'
    assert [text[a:b] for a, b in balanced_blocks(text)] == ['[{"a": "]"}]', '{"b": 1}']
    assert parse_content(text) == ('[{"a": "]"}]', "block")
    assert salvage_objects('[{"a": 1}, {"b": oops}, {"c": 2') == [{"a": 1}, {"c": 2}]
    assert parse_content("")[1] == "empty" and parse_content("nothing")[1] == "failed"


def test_selection(spark):
    rows = [(1, 2, 1, "[1]"), (2, 2, 1, "[999]"), (3, 2, 2, "[1]"), (4, 3, 2, "[3, 3, 1, 2]"), (5, 2, 1, "oops")]
    got = {r.batch: (r.picks, r.surplus, r.error) for r in responses.select_local_ids(spark.createDataFrame(rows, "batch long, size int, expected int, response string")).collect()}
    assert got[1] == ([1], 0, None) and got[4] == ([3, 1], 1, None)
    assert all("expected exactly" in got[i][2] for i in (2, 3, 5))


def test_waterfall_takes_each_word_once():
    words = [(1, "casă", "N"), (2, "casa", "N"), (3, "om", "V")]
    nodes = [{"word_id": 1, "rarity_level": 2}, {"word_id": 1, "word": "casa", "type": "N", "rarity_level": "4"}, {"word": "omm", "type": "V", "rarity_level": 5, "confidence": 90}, {"word": "om", "type": "V", "rarity_level": 9}]
    got = {r[0]: (r[3], r[6]) for r in responses._waterfall(words, nodes, True)}
    assert got == {1: (2, "id"), 2: (4, "word"), 3: (5, "fuzzy")}
    with pytest.raises(ValueError):
        responses._waterfall(words, [], True)
