import functools
import http.server
import json
import sqlite3
import threading
import time

import pandas as pd
import pytest

from lexirank import cli
from lexirank.operators import scoring
from lexirank.operators.endpoint import Abilities, ChatScorer, ChatSelector, Endpoint, content_text, detect, json_or_text, payload, picked_ids, preflight, profile_of, prompt, results_schema, selection_schema
from lexirank.operators.journal import Journal
from lexirank.operators.selection import chosen
from lexirank.sources import tables
from lexirank.sources.uploads import Database


def put(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.fixture
def files(spark, tmp_path):
    head = "word_id,word,type,rarity_level,tag,confidence,scored_at,model,run_slug\n"
    base = put(tmp_path / "base.csv", "word_id,word,type\n" + "".join(f"{i},w{i},N\n" for i in range(1, 41)))
    runs = [put(tmp_path / f"{n}.csv", head + "".join(f"{i},w{i},N,{(i + k) % 5 + 1},t,0.8,x,m,{n}\n" for i in range(1, 41))) for k, n in enumerate("abc")]
    return base, runs, tmp_path


def test_compare_audit_rebalance(spark, files, capsys):
    base, (a, b, c), tmp = files
    out = str(tmp / "out")
    assert cli.main(["step3", "--run-a-csv", a, "--run-b-csv", b, "--run-c-csv", c, "--base-csv", base, "--output-csv", f"{out}/m.csv", "--outliers-csv", f"{out}/o.csv", "--merge-strategy", "any-extremes"]) == 0
    assert tables.read_csv(spark, f"{out}/m.csv").count() == 40
    assert cli.main(["dist", "--csv", f"{out}/m.csv"]) == 0
    assert cli.main(["quality-audit", "--candidate-csv", a, "--reference-csv", b, "--min-l1-jaccard", "0.5"]) == 1
    assert cli.main(["--output-dir", out, "step5", "--run", "r", "--model", "m", "--input-csv", a, "--output-csv", f"{out}/r.csv", "--transitions", "2:1,4:4", "--batch-size", "5", "--pick", "score"]) == 0
    assert tables.read_csv(spark, f"{out}/r.csv").where("rebalance_rule <> ''").count() > 0
    assert cli.main(["step5", "--run", "r", "--model", "m", "--input-csv", a, "--output-csv", f"{out}/r.csv", "--from-level", "2", "--pick", "score"]) == 2


def test_rebalance_names_no_model_that_was_not_asked(spark, files):
    _, (a, _, _), tmp = files
    assert cli.main(["--output-dir", str(tmp), "step5", "--run", "r", "--model", "m", "--input-csv", a, "--output-csv", f"{tmp}/r.csv", "--transitions", "2:1", "--batch-size", "5", "--pick", "score"]) == 0
    rows = tables.read_csv(spark, f"{tmp}/r.csv").where("rebalance_rule <> ''").collect()
    assert rows and all(not r.rebalance_model and r.rebalance_run == "r" for r in rows)


def test_review_and_retry(spark, files):
    base, (a, _, _), tmp = files
    labels = put(tmp / "labels.csv", "word_id,predicted_level,label\n1,1,1\n2,1,undecided\n")
    assert cli.main(["review", "--csv", a, "--labels-csv", labels, "--only-levels", "1"]) == 0
    assert cli.main(["l1-review-check", "--labels-csv", labels]) == 0
    failed = put(tmp / "f.jsonl", '{"word_id": 3}\nbroken\n')
    assert cli.main(["build-retry-input", "--failed-jsonl", failed, "--base-csv", base, "--output-csv", str(tmp / "retry")]) == 0
    assert [r.word_id for r in tables.read_csv(spark, str(tmp / "retry")).collect()] == ["3"]


def test_endpoint_is_found_by_path_then_by_asking():
    assert detect("http://h/api/v1/chat") == Endpoint("http://h", "native")

    def only_native(url, timeout):
        if "/api/" not in url:
            raise OSError("no")
        return "[m1]"

    assert detect(base="http://h", get=only_native).flavour == "native"
    assert preflight(Endpoint("http://h", "native"), "m2", only_native) == ["the endpoint doesn't list m2"]

    def down(url, timeout):
        raise OSError("down")

    assert detect(get=down).flavour == "openai"
    other = detect("http://h:1/custom/score?key=1")
    assert other.url("chat") == "http://h:1/custom/score?key=1" and preflight(other, "m", down) == []


def test_no_prompt_lacks_its_entries():
    assert prompt("{count} of {{INPUT_JSON}}", [{"word": "ă"}], count=1) == '1 of [{"word": "ă"}]'
    assert prompt("{words}", [], count=0) == "[]"
    assert prompt("Score these.", [{"word": "x"}], count=1) == 'Score these.\n\n[{"word": "x"}]'


def test_schemas_are_closed():
    schema = results_schema(2)
    item = schema["properties"]["results"]["items"]
    assert sorted(item["required"]) == sorted(item["properties"]) and len(item["required"]) == 6
    assert not item["additionalProperties"] and not schema["additionalProperties"]


def test_requests_and_answers_are_logged(spark, tmp_path):
    def post(url, body, timeout):
        if body["max_tokens"] < 300:
            raise ConnectionError("connection refused")
        return {"choices": [{"message": {"content": '[{"word_id": 1, "rarity_level": 2, "confidence": 1}]'}}]}

    log = Journal(str(tmp_path / "log"))
    scorer = ChatScorer(Endpoint("http://h", "openai"), "m", "s", "{words}", post=post, log=log)
    scorer(pd.DataFrame({"word_id": [1, 2, 3], "word": ["a", "b", "c"], "type": ["N"] * 3}))
    with pytest.raises(ConnectionError):
        scorer(pd.DataFrame({"word_id": [1], "word": ["a"], "type": ["N"]}))
    scorer.flush()
    rows = log.table(spark, "model string, request struct<messages:array<struct<content:string>>>, response string").collect()
    assert [r.model for r in rows] == ["m", "m"] and "word_id" in rows[0].request.messages[1].content
    assert "rarity_level" in rows[0].response and rows[1].response == "connection refused"


def test_scorer_learns_what_is_refused():
    sent = []

    def post(url, body, timeout):
        sent.append(body.get("response_format", {}).get("type"))
        if sent[-1] == "json_object":
            raise ValueError("'response_format.type' must be 'json_schema' or 'text'")
        if sent[-1] == "json_schema":
            raise ValueError("response_format unsupported")
        return {"choices": [{"message": {"content": [{"text": '```[{"word_id": 1, "rarity_level": 2, '}, {"text": '"confidence": 1.}]'}]}}]}

    scorer = ChatScorer(Endpoint("http://h", "openai"), "m", "s", "{count}: {words}", post=post)
    got = scorer(pd.DataFrame({"word_id": [1, 2], "word": ["a", "bcdef"], "type": ["N", "N"]}))
    assert sent == ["json_object", "json_schema", None]
    assert got.values.tolist() == [[1, 2, "uncertain", 1.0, "id"]]
    assert Abilities.of(Endpoint("", "native")).format == "none"


def test_payload():
    body = payload("OpenAI/GPT-OSS-20B", "s", "u", tokens=100, abilities=Abilities(), schema={})
    assert body["reasoning_effort"] == "low" and body["max_tokens"] == 100 and json.dumps(body)
    assert body["top_k"] == 40 and payload("openai/gpt-oss-20b", "s", "u", tokens=9000, abilities=Abilities(), schema={})["max_tokens"] == 4096
    assert profile_of("other").reasoning_effort is None
    glm = payload("zai-org/glm-4.7-flash", "s", "u", tokens=9000, abilities=Abilities(), schema={})
    assert (glm["max_tokens"], glm["thinking"], glm["chat_template_kwargs"]) == (2048, {"type": "disabled"}, {"enable_thinking": False})
    native = payload("zai-org/glm-4.7-flash", "s", "u", tokens=100, abilities=Abilities.of(Endpoint("http://h", "native")), schema={})
    assert not {"thinking", "reasoning_effort", "response_format"} & set(native)
    assert json_or_text("[1]") == [1] and json_or_text("no") == "no"
    assert content_text({"choices": [{"message": {"content": ["```json\n[1", {"text": ", 2]\n```"}]}}]}) == "[1, 2]"
    assert selection_schema(9, 3)["maxItems"] == 3
    assert content_text({"output_text": "x"}) == "x"
    with pytest.raises(ValueError):
        content_text({})


def test_schema_is_given_up_where_it_does_harm():
    a = Abilities("json_schema")
    a.answered(10, 1)
    assert a.format == "json_schema"
    a.answered(10, 2)
    assert a.format == "none"
    a = Abilities("json_schema")
    assert a.refused("no valid results parsed from 0 result nodes") and a.format == "none"


def test_picks_by_number_and_by_word():
    words = ["casă", "om", "țară", "om"]
    assert picked_ids([2, "3", 2, 9, 1], words, 2) == [2, 3]
    assert picked_ids({"picks": [{"local_id": 4}, {"word": "Casă!"}]}, words, 2) == [4, 1]
    assert picked_ids(["om", "om"], words, 2) == [2, 4]
    with pytest.raises(ValueError, match="expected exactly 2 selected, got 1"):
        picked_ids([1], words, 2)


def test_a_selection_is_repaired_then_halved():
    words = [f"w{i}" for i in range(8)]
    asked = []

    def short(part, count, repair):
        asked.append((len(part), count, repair))
        return list(range(1, count + 1)) if repair else [1]

    assert chosen(short, words, 3) == {0, 1, 2} and asked == [(8, 3, False)] * 3 + [(8, 3, True)]
    asked.clear()

    def small_only(part, count, repair):
        asked.append((len(part), repair))
        if len(part) > 4:
            raise ValueError("Missing content")
        return list(range(len(part), 0, -1))

    assert chosen(small_only, words, 3) == {3, 2, 7} and (8, True) not in asked  # 2 of the first half, 1 of the second
    assert chosen(small_only, words, 0) == set() and chosen(small_only, words, 8) == set(range(8))

    def down(part, count, repair):
        raise ConnectionError("connection refused")

    with pytest.raises(scoring.Unreachable):
        chosen(down, words, 3)


def test_selector_asks_for_local_ids():
    sent = []

    def post(url, body, timeout):
        sent.append(body)
        return {"choices": [{"message": {"content": "```json\n[2, 1]\n```"}}]}

    selector = ChatSelector(Endpoint("http://h", "openai"), "m", "choose {count}", "{count} of {size}: {words}", post=post)
    assert selector(["a", "b", "c"], 2) == [2, 1]
    assert sent[0]["messages"][0]["content"] == "choose 2" and sent[0]["messages"][1]["content"].startswith('2 of 3: [{"local_id": 1, "word": "a"}')


def _listening(post):
    """An endpoint that is there, and answers by a function."""
    return lambda o, kind, system, template: kind(Endpoint("http://h", "openai"), o.model, "s", "{words}", post=post)


class Stub:
    """An endpoint that counts how many calls it gets, and how many at once; after so many words it drops calls unanswered."""

    def __enter__(self):
        stub = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):
                with stub.lock:
                    stub.calls += 1
                    stub.at_once += 1
                    stub.most = max(stub.most, stub.at_once)
                body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                words = json.loads(body["messages"][1]["content"])
                time.sleep(0.02)
                with stub.lock:
                    stub.at_once -= 1
                    down = stub.limit is not None and stub.answered >= stub.limit
                    stub.after += down
                    stub.answered += 0 if down else len(words)
                    stub.asked += [] if down else [w["word_id"] for w in words]
                if down:
                    self.close_connection = True
                    return
                answer = json.dumps({"choices": [{"message": {"content": json.dumps([w | {"rarity_level": 2, "confidence": 0.5, "tag": "t"} for w in words])}}]}).encode()
                self.send_response(200)
                self.send_header("Content-Length", str(len(answer)))
                self.end_headers()
                self.wfile.write(answer)

            def log_message(self, *a):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        return self

    def __init__(self, limit=None):
        self.lock, self.limit = threading.Lock(), limit
        self.calls = self.at_once = self.most = self.answered = self.after = 0
        self.asked = []

    def __exit__(self, *a):
        self.server.shutdown()

    def scorer(self):
        return ChatScorer(Endpoint(f"http://127.0.0.1:{self.server.server_port}", "openai"), "m", "s", "{words}")


def test_an_endpoint_gets_no_more_calls_than_it_has_slots(spark):
    words = spark.range(300).selectExpr("id as word_id", "concat('w', id) as word", "'N' as type")
    with Stub() as stub:
        rows = scoring.score_words(words, stub.scorer(), batch_size=5, slots=2).collect()
        assert len(rows) == 300 and stub.most == 2 and {r.matched for r in rows} == {"id"}
        scoring.score_words(words, stub.scorer(), batch_size=5).collect()
        assert stub.most > 2


def test_calls_after_an_outage_are_bounded(spark, tmp_path):
    """Each task makes at most as many further calls as a batch has attempts, none fails, and the next run asks for the rest once."""
    words = spark.range(2000).selectExpr("id as word_id", "concat('w', id) as word", "'N' as type")
    journal, retry = Journal(str(tmp_path / "j")), scoring.Retry(attempts=3)
    with Stub(limit=200) as stub:
        rows = scoring.score_words(words, stub.scorer(), batch_size=20, retry=retry, journal=journal).collect()
        assert journal.tripped() and 0 < stub.after <= retry.attempts * spark.sparkContext.defaultParallelism
        assert {r.word_id for r in rows} == set(stub.asked) and len(stub.asked) == len(set(stub.asked))
        kept = journal.table(spark, scoring.SCORED).filter("rarity_level is not null")
        stub.limit = None
        more = scoring.score_words(words.join(kept.select("word_id"), "word_id", "left_anti"), stub.scorer(), batch_size=20, retry=retry, journal=journal).collect()
        assert not journal.tripped() and {r.word_id for r in rows} | {r.word_id for r in more} == set(range(2000))
        assert len(stub.asked) == len(set(stub.asked)) == 2000


def test_an_outage_after_a_part_of_a_batch_ends_it():
    asked = []

    def scorer(batch):
        asked.append(len(batch))
        if len(asked) > 1:
            raise ConnectionError("connection refused")
        return pd.DataFrame({"word_id": batch["word_id"][:1], "rarity_level": [2], "tag": ["t"], "confidence": [0.5]})

    batch = pd.DataFrame({"word_id": range(50), "word": ["w"] * 50, "type": ["N"] * 50})
    with pytest.raises(scoring.Unreachable) as x:
        scoring.resilient(scorer, batch, scoring.Retry(attempts=3))
    assert len(asked) == 3 and x.value.done["word_id"].tolist() == [0]


def test_a_task_that_runs_again_asks_for_nothing_twice(spark, tmp_path):
    """The same plan twice, as after the loss of an executor: words that failed aren't asked for again either."""
    folder = tmp_path / "asked"
    folder.mkdir()

    def scorer(batch):
        for i in batch["word_id"]:
            path = folder / str(i)
            path.write_text((path.read_text() if path.exists() else "") + "x")
        good = batch[batch["word_id"] % 10 != 3]
        return pd.DataFrame({"word_id": good["word_id"], "rarity_level": 2, "tag": "t", "confidence": 0.5})

    words = spark.range(100).selectExpr("id as word_id", "'w' as word", "'N' as type")
    plan = scoring.score_words(words, scorer, batch_size=10, retry=scoring.Retry(attempts=1, depth=0), journal=Journal(str(tmp_path / "j")))
    first, second = ({(r.word_id, r.rarity_level) for r in plan.collect()} for _ in range(2))
    assert first == second and len(first) == 100
    assert len(list(folder.iterdir())) == 100 and all(p.read_text() == "x" for p in folder.iterdir())


def test_counters_are_those_of_a_second_pass(spark, tmp_path):
    from lexirank.operators import counters

    def scorer(batch):
        good = batch[batch["word_id"] % 4 != 3]
        return pd.DataFrame({"word_id": good["word_id"], "rarity_level": 2, "tag": "t", "confidence": 0.5, "matched": "id"})

    words = spark.range(100).selectExpr("id as word_id", "'w' as word", "'N' as type")
    plan, got = counters.counted(scoring.score_words(words, scorer, retry=scoring.Retry(attempts=1)), counters.scoring())
    plan.write.parquet(str(tmp_path / "log"))
    again = spark.read.parquet(str(tmp_path / "log")).agg(*[c.alias(n) for n, c in counters.scoring().items()]).first().asDict()
    assert got() == again and (again["scored"], again["failed"], again["by_id"], again["error_other"]) == (75, 25, 75, 25)


def test_rebalance_by_a_model_is_taken_up_where_it_stopped(spark, files, monkeypatch):
    _, (a, _, _), tmp = files
    folder = tmp / "asked"
    folder.mkdir()

    def post(url, body, timeout, most=None):
        import os
        import uuid

        if most is not None and len(os.listdir(folder)) >= most:
            raise ConnectionError("connection refused")
        (folder / uuid.uuid4().hex).write_text("")
        words = json.loads(body["messages"][1]["content"])
        return {"choices": [{"message": {"content": json.dumps([w["local_id"] for w in words][::-1])}}]}

    run = ["--output-dir", str(tmp / "out"), "step5", "--run", "r", "--model", "m", "--input-csv", a, "--output-csv", f"{tmp}/r.csv", "--transitions", "2:1", "--batch-size", "3", "--max-retries", "1"]
    monkeypatch.setattr(cli, "_chat", _listening(lambda u, b, t: post(u, b, t, 1)))
    with pytest.raises(Exception, match="connection refused"):
        cli.main(run)
    before = len(list(folder.iterdir()))
    assert before >= 1
    monkeypatch.setattr(cli, "_chat", _listening(post))
    assert cli.main(run) == 0
    batches = 3  # of eight words of level 2: two of three, and one of two
    assert len(list(folder.iterdir())) == batches
    rows = tables.read_csv(spark, f"{tmp}/r.csv").where("rebalance_rule <> ''").collect()
    assert rows and all(r.rebalance_model == "m" and r.final_level == "1" for r in rows)
    checkpoint = tables.read_checkpoint(spark, f"{tmp}/out/rebalance/checkpoints/r.jsonl").collect()
    assert sorted(r.batch for r in checkpoint) == [0, 1, 2] and sum(len(r.switched) for r in checkpoint) == len(rows)
    progress = spark.read.json(f"{tmp}/out/rebalance/progress/r.jsonl").collect()
    assert len(progress) == batches and min(r.remaining for r in progress) == 0
    switched = spark.read.json(f"{tmp}/out/rebalance/switched_words/r.jsonl").collect()
    assert {r.word_id for r in switched} == {int(r.word_id) for r in rows} and {r.model for r in switched} == {"m"}


@pytest.mark.parametrize("stop", ["switched_words", "progress", "checkpoints"])
def test_a_rebalance_goes_on_in_the_transition_where_it_stopped(spark, files, monkeypatch, stop):
    """Stopped in the second of three transitions, at each of its logs: no row is in a log twice, and the output is that of a run in one go."""
    _, (a, _, _), tmp = files
    append, apply, done = cli.sinks.append_json, cli.rebalance.apply_transition, []

    def run(name, out):
        return ["--output-dir", str(tmp / out), "step5", "--run", name, "--model", "m", "--input-csv", a, "--output-csv", f"{tmp}/{out}.csv", "--transitions", "2:1,3:2,5:4", "--batch-size", "3", "--pick", "score"]

    def stopping(df, path, key=""):
        if key.endswith("-2") and stop in path:
            raise KeyboardInterrupt
        append(df, path, key)

    def noting(words, transition, **options):
        done.append(transition.text)
        return apply(words, transition, **options)

    monkeypatch.setattr(cli.sinks, "append_json", stopping)
    monkeypatch.setattr(cli.rebalance, "apply_transition", noting)
    with pytest.raises(KeyboardInterrupt):
        cli.main(run("r", "out"))
    monkeypatch.setattr(cli.sinks, "append_json", append)
    assert cli.main(run("r", "out")) == 0
    assert done == ["2:1", "3:2", "3:2", "5:4"]
    assert cli.main(run("r", "out")) == 0 and len(done) == 4  # all is there
    assert cli.main(run("r", "other")) == 0
    rows = lambda out: sorted((r.word_id, r.final_level, r.rebalance_rule) for r in tables.read_csv(spark, f"{tmp}/{out}.csv").collect())
    assert rows("out") == rows("other") and any(r[2] for r in rows("out"))
    for log, key in (("switched_words", ["word_id"]), ("progress", ["transition", "batch"]), ("checkpoints", ["fingerprint", "transition", "batch"])):
        got, want = (spark.read.json(f"{tmp}/{out}/rebalance/{log}/r.jsonl").select(*key).collect() for out in ("out", "other"))
        assert sorted(got) == sorted(want) and len(set(got)) == len(got)


def test_scoring_goes_on_after_an_outage(spark, files, monkeypatch):
    base, _, tmp = files
    folder = tmp / "scored"
    folder.mkdir()

    def post(url, body, timeout, last=None):
        words = json.loads(body["messages"][1]["content"])
        if last is not None and words[0]["word_id"] > last:
            for _ in range(600):  # until others have been answered
                if any(folder.iterdir()):
                    break
                time.sleep(0.1)
            raise ConnectionError("connection refused")
        for w in words:
            path = folder / str(w["word_id"])
            path.write_text(path.read_text() + "x" if path.exists() else "x")
        return {"choices": [{"message": {"content": json.dumps([w | {"rarity_level": 2, "confidence": 0.5, "tag": "t"} for w in words])}}]}

    run = ["--output-dir", str(tmp / "out"), "step2", "--run", "r", "--model", "m", "--base-csv", base, "--output-csv", f"{tmp}/s.csv", "--batch-size", "5", "--max-retries", "1"]
    monkeypatch.setattr(cli, "_chat", _listening(lambda u, b, t: post(u, b, t, 20)))
    with pytest.raises(Exception, match="connection refused"):
        cli.main(run)
    first = {p.name for p in folder.iterdir()}
    assert first and len(first) < 40
    monkeypatch.setattr(cli, "_chat", _listening(post))
    assert cli.main(run) == 0
    assert tables.read_csv(spark, f"{tmp}/s.csv").count() == 40
    assert len(list(folder.iterdir())) == 40 and all(p.read_text() == "x" for p in folder.iterdir())
    assert not (tmp / "out/runs/r.journal").exists()


def test_sizes_follow_outcomes():
    assert scoring.next_size(30, [False], 50) == 20 and scoring.next_size(20, [True], 50) == 30 and scoring.next_size(4, [False], 50) == 3
    assert scoring.next_size(50, [True] * 10, 50) == 50 and scoring.next_size(30, [True, False], 50) == 30


def test_journal(tmp_path, spark):
    j = Journal(str(tmp_path / "j"))
    assert j.get("a") is None and j.table(spark, "x long").count() == 0
    j.put("a", [{"x": 1}, {"x": 2}])
    assert j.get("a") == [{"x": 1}, {"x": 2}] and j.table(spark, "x long").count() == 2
    j.clear()
    assert j.get("a") is None
    j.clear()


def test_upload_reports_the_levels_before_it(spark, tmp_path, monkeypatch):
    """A database that changes when it is written to: the report and the marks tell what was there before, and a run that was stopped is taken up."""
    path = str(tmp_path / "words.db")
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE words (id INTEGER PRIMARY KEY, rarity_level INTEGER)")
        c.executemany("INSERT INTO words VALUES (?, ?)", [(101, 5), (102, 1)])
    read = lambda: dict(sqlite3.connect(path).execute("SELECT id, rarity_level FROM words"))
    monkeypatch.setattr(cli.tables, "database_options", lambda: {"url": "x"})
    monkeypatch.setattr(cli, "_database", lambda options: Database(functools.partial(sqlite3.connect, path, timeout=60), "?"))
    monkeypatch.setattr(cli.tables, "read_words_table", lambda *a: spark.createDataFrame(sorted(read().items()), "word_id long, rarity_level int"))
    final = put(tmp_path / "final.csv", "word_id,word,type,final_level\n101,a,N,2\n102,b,N,5\n103,c,N,1\n")
    run = ["--output-dir", str(tmp_path / "out"), "step4", "--final-csv", final, "--report-csv", str(tmp_path / "report")]
    replace = cli.sinks.replace

    def stopped(*a):
        raise KeyboardInterrupt

    monkeypatch.setattr(cli.sinks, "replace", stopped)  # after the database has changed
    with pytest.raises(KeyboardInterrupt):
        cli.main(run)
    assert read() == {101: 2, 102: 5}
    monkeypatch.setattr(cli.sinks, "replace", replace)
    assert cli.main([*run, "--mode", "full-fallback"]) == 2  # not what was stopped
    assert cli.main(run) == 0
    report = {r.word_id: (r.previous_level, r.new_level, r.source) for r in tables.read_csv(spark, str(tmp_path / "report")).collect()}
    assert report == {"101": ("5", "2", "final_csv"), "102": ("1", "5", "final_csv"), "103": ("", "", "missing_db_word")}
    assert read() == {101: 2, 102: 5}
    marks = {r.word_id: r.upload_status for r in tables.read_csv(spark, final).collect()}
    assert marks == {"101": "uploaded", "102": "uploaded", "103": "missing_db_word"}
    assert not (tmp_path / "out/upload.pending.json").exists()
