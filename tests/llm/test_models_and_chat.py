"""Quality classifier, SentencePiece, tool calls."""

import json
import random
from collections import Counter

import numpy as np
import pytest
from conftest import SF_SMALL


def test_factorisation_machine_equals_pairwise_sum():
    from ferrolake.llm.quality import N_FEATURES, Model
    rng = np.random.default_rng(0)
    m = Model(0.3, rng.normal(size=N_FEATURES), rng.normal(size=(N_FEATURES, 4)))
    idx, val = rng.choice(N_FEATURES, 12, replace=False), rng.normal(size=12)
    want = 0.3 + m.w[idx] @ val + sum(m.v[idx[i]] @ m.v[idx[j]] * val[i] * val[j] for i in range(12) for j in range(i))
    assert abs(m.raw(idx, val, np.array([0]))[0][0] - want) < 1e-9


def test_quality_held_out_accuracy(spark):
    import zlib

    from ferrolake.llm.quality import quality_report
    docs, labels = (spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in quality_report(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    held = [(rows[r.doc_id].predicted, r.quality) for r in labels.collect() if rows[r.doc_id].held_out]
    assert np.mean([p == q for p, q in held]) > 0.95
    assert np.mean([p for p, q in held if q == 1]) > 0.97


def test_quality_edges(spark, edge_docs, edges, no_docs):
    from ferrolake.llm.quality import keep_good, quality_report
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (7, 0), (20, 1), (21, 0), (22, 1), (999, 1)], "doc_id long, quality int")
    rows = quality_report(edge_docs, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in edges) and all(0 <= r.score <= 1 for r in rows)
    assert keep_good(edge_docs, edge_docs, labels).columns == edge_docs.columns
    assert {r.score for r in quality_report(edge_docs, labels.limit(0)).collect()} == {0.5}
    assert quality_report(no_docs, labels).collect() == []


def test_quality_sample_survives_repeated_ids(spark, monkeypatch):
    import zlib

    from ferrolake.llm import quality
    ids = [i for i in range(30) if zlib.crc32(str(i).encode()) % 3 != 1][:6]
    docs = [(ids[0], f"text number {i}", 10) for i in range(60)] + [(i, "another text", 10) for i in ids[1:]]
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, labels: seen.append(labels.tolist()))
    for parts in (1, 5):
        quality.train(spark.createDataFrame(docs, "doc_id long, text string, n_chars long").repartition(parts),
                      spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)], "doc_id long, quality int"), sample=6)
    assert seen == [[0.0, 1.0, 0.0, 1.0, 0.0, 1.0]] * 2


@pytest.fixture(scope="module")
def pieces():
    import os

    from ferrolake.llm.sentencepieces import MODEL_PATH, pieces_of
    if not os.path.exists(MODEL_PATH):
        pytest.skip("no tokenizer files here")
    with open(MODEL_PATH, "rb") as f:
        model = f.read()
    return pieces_of(model), model


TEXTS = ["", "Hello world", "  two  spaces ", " ", "   ", "a\nb\tc\r\n", "é ﬁ ½", "日本語 𝔘 漢字" * 30, "x" * 500, "ab" * 90, "\x00\x7f", "▁a ▁", "a▁ b", "don't stop"]


def cut(flat, n):
    return [x.tolist() for x in np.split(flat, np.cumsum(n)[:-1])]


def test_without_dropout_pieces_equal_the_library(pieces):
    import sentencepiece

    from ferrolake.llm.sentencepieces import encode_texts
    sp = sentencepiece.SentencePieceProcessor(model_proto=pieces[1])
    texts = [t for t in TEXTS if "▁" not in t]  # the library takes a literal U+2581 for a space
    assert cut(*encode_texts(pieces[0], texts, [0] * len(texts), dropout=0.0)) == [sp.encode(t) for t in texts]


def test_dropout_round_trip_and_agendas(pieces, monkeypatch):
    from ferrolake.llm import sentencepieces as s
    p = pieces[0]
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice("aeinrst  éß▁\n") for _ in range(rng.randrange(200))) for _ in range(100)]
    first = cut(*s.encode_texts(p, texts, list(range(len(texts))), dropout=0.3))
    assert [s.decode(p, x) for x in first] == texts
    assert first == cut(*s.encode_texts(p, texts, list(range(len(texts))), dropout=0.3))
    other = cut(*s.encode_texts(p, texts, list(range(len(texts))), dropout=0.3, seed=99))
    assert other != first and [s.decode(p, x) for x in other] == texts
    words = sorted({w for t in texts for w in s.split_words(t)})
    lanes = np.arange(len(words)) % 4
    monkeypatch.setattr(s, "LONG", 10**9)
    lockstep = s.encode_words(p, words, lanes, 0.3, 7)
    monkeypatch.setattr(s, "LONG", 0)
    heap = s.encode_words(p, words, lanes, 0.3, 7)
    assert all((a == b).all() for a, b in zip(lockstep, heap))


def test_candidates_and_agendas_side_by_side(pieces):
    """Candidates are found by hashing, and words of like length share matrices, whose height no word need reach."""
    from ferrolake.llm import sentencepieces as s
    pieces = pieces[0]
    assert len(pieces.pair) >= 4 * len(pieces.merge)
    pairs = np.array([*pieces.merge, *(k + 1 for k in pieces.merge)], np.int64)
    rank, into = pieces.candidates((pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32))
    want = [pieces.merge.get(k) for k in pairs.tolist()]
    assert [(r, i) if r < s._NEVER else None for r, i in zip(rank.tolist(), into.tolist())] == want
    rng = random.Random(8)
    words = [" " + "".join(rng.choices("aeinrst\u00e9", k=k % s.LONG)) for k in range(3 * s.LONG)]
    sym, lens, hashed = pieces.symbols(words)
    start = np.cumsum(lens) - lens
    short = lens <= s.LONG
    for dropout in (0, 0.3):
        got, n = s._lockstep(pieces, sym[np.repeat(short, lens)], lens[short], hashed[short], dropout)
        own = [s._heap_word(pieces, sym[a:a + k], key, dropout) for a, k, key in zip(start[short], lens[short], hashed[short])]
        assert n.tolist() == list(map(len, own)) and got.tolist() == [x for w in own for x in w]


def test_every_occurrence_is_cut_on_its_own(pieces):
    from ferrolake.llm.sentencepieces import encode_texts
    word = " international"
    text = (word * 2000)[1:]
    ways = {tuple(x) for x in cut(*encode_texts(pieces[0], ["international"] * 2000, list(range(2000))))}
    assert len(ways) > 20
    a, b, c = cut(*encode_texts(pieces[0], [text] * 3, [1, 1, 1], copies=[0, 1, 0]))
    assert a != b and a == c
    whole = cut(*encode_texts(pieces[0], ["of"] * 4000, list(range(4000))))  # one merge or two: nearly nine in ten stay whole
    assert 0.78 < sum(len(x) == 1 for x in whole) / 4000 < 0.93


def test_sentencepiece_edges(spark, pieces, edge_docs, edges, no_docs):
    from ferrolake.llm.sentencepieces import decoded, encode
    out = encode(edge_docs)
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in edges)
    assert all(r.round_trip and r.n_pieces == len(r.pieces) for r in rows)
    assert Counter(tuple(r) for r in decoded(out).collect()) == Counter((i, t or "") for i, t, *_ in edges)
    assert encode(no_docs).collect() == []


CALLS = "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>, conv string, extra int"
RESULTS = "conv_id long, turn long, call_id string, content string, c string"
SCHEMAS = {"f": {"type": "object", "required": ["a"], "additionalProperties": False,
                 "properties": {"a": {"type": "integer", "minimum": 1}, "b": {"type": "array", "items": {"type": "string", "maxLength": 2}}}}}


def linked_rows(spark, calls, results, **params):
    from ferrolake.llm.tool_calls import linked
    c = spark.createDataFrame([(*x, "x", 1) for x in calls], CALLS)
    r = spark.createDataFrame([(*x, "y") for x in results], RESULTS)
    return linked(spark, c, r, SCHEMAS, **params).collect()


def test_tool_calls(spark):
    calls = [(1, 5, "a", "f", '{"a": 2.0, "b": ["x"]}', ["b", "zz"]), (1, 9, "b", "f", '{"b":["xyz"],"c":1,"a":0}', []), (1, 2, "c", "g", "{}", []),
             (1, 2, "c", "g", "{}", []), (2, 1, "a", "f", "not json", None), (2, 2, "x", "f", None, ["y"]), (2, 3, "y", "f", '{"a":1}', ["x"]),
             (None, None, None, None, None, None), (3, 1, "a", "f", '{"a":1}', []), (3, 2, "b", "f", '{"a":NaN}', ["a"])]
    results = [(1, 6, "a", "late"), (1, 5, "a", "soon"), (2, 4, "q", "lost"), (4, None, None, None), (3, 3, "b", None)]
    for group_calls in (50_000, 0):  # Kahn in one task, and peeling
        rows = linked_rows(spark, calls, results, group_calls=group_calls)
        by = {(r.conv_id, r.call_id): r for r in rows}
        assert len(rows) == 11
        assert [by[1, x].step for x in "abc"] == [1, 0, 0] and by[1, "a"].missing == ["zz"] and by[1, "c"].copies == 2
        assert by[1, "a"].json == '{"arguments":{"a":2,"b":["x"]},"id":"a","name":"f","needs":["b","zz"],"result":"soon","valid":true}'
        assert by[1, "b"].errors == "$.c: unknown; $.a: below minimum; $.b[0]: above maxLength" and not by[1, "b"].valid
        assert by[1, "c"].errors == "unknown tool" and by[2, "a"].errors == "malformed arguments" == by[3, "b"].errors
        assert json.loads(by[2, "a"].json)["arguments"] == "not json"
        assert by[2, "x"].step is None and by[2, "y"].step is None  # a cycle
        assert (by[3, "a"].step, by[3, "b"].step, by[3, "b"].status, by[3, "a"].status) == (1, 2, "answered", "unanswered")
        assert by[2, "q"].status == "orphan" == by[4, None].status and by[None, None].status == "unanswered"
    assert linked_rows(spark, [], []) == []


def test_tool_calls_order_is_topological(spark):
    rng = random.Random(6)
    calls, needs = [], {}
    for conv in range(6):
        turns = rng.sample(range(40), 15)
        for k, t in enumerate(turns):
            needs[conv, f"c{k}"] = [f"c{j}" for j in rng.sample(range(k), min(k, 2))]
            calls.append((conv, t, f"c{k}", "f", '{"a":1}', needs[conv, f"c{k}"]))
    step = {(r.conv_id, r.call_id): r.step for r in linked_rows(spark, calls, [])}
    assert all(step[conv, x] < step[conv, c] for (conv, c), of in needs.items() for x in of)


def test_chat_query_counts(spark):
    from ferrolake.llm.queries import op8_tool_calls
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()
    users = {(r.conv_id, r.turn) for r in turns if r.role == "user"}
    answers = {(r.conv_id, r.turn - 1) for r in turns if r.role == "assistant"}
    others = sum(r.role not in ("user", "assistant") for r in turns)
    rows = op8_tool_calls(spark, SF_SMALL).collect()
    got = Counter(r.status for r in rows)
    assert got == Counter({k: v for k, v in {"answered": len(users & answers), "unanswered": len(users - answers), "orphan": len(answers - users),
                                             "message": others}.items() if v})
    calls = [r for r in rows if r.status in ("answered", "unanswered")]
    assert any(r.step != r.turn for r in calls) and any(r.missing for r in calls)   # it sorts, and some needs name no call


def brute_levels(needs):
    """Longest chain of known needs below each call; None on or behind a cycle."""
    known = {i: {x for x in of if x in needs} for i, of in needs.items()}
    level, rounds = {i: 0 for i, of in known.items() if not of}, True
    while rounds:
        more = {i: 1 + max(level[x] for x in of) for i, of in known.items() if i not in level and of <= level.keys()}
        level |= more
        rounds = bool(more)
    return {i: level.get(i) for i in needs}


@pytest.mark.parametrize("group_calls", [50_000, 0])
def test_steps_are_longest_ways(spark, group_calls):
    rng = random.Random(group_calls + 1)
    graphs = {}
    for conv in range(8):   # single needs, several, unknown ones, and cycles
        n = rng.randrange(3, 25)
        graphs[conv] = {f"c{i}": [f"c{rng.randrange(n + 1 if conv % 3 == 0 else max(i, 1))}" for _ in range(rng.choice([0, 1, 1, 1, 2, 3]))] if i else [] for i in range(n)}
    graphs[100] = {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(300)}      # a chain
    graphs[101] = {f"c{i}": [f"c{(i + 1) % 40}"] for i in range(40)} | {"tail": ["c7"], "both": ["c7", "free"], "free": []}
    calls = [(conv, 500 - i, c, "f", '{"a":1}', of) for conv, g in graphs.items() for i, (c, of) in enumerate(g.items())]
    rows = linked_rows(spark, calls, [], group_calls=group_calls)
    got = {}
    for r in rows:
        got.setdefault(r.conv_id, {})[r.call_id] = r.step
    backward = {conv for conv, g in graphs.items() if not any(x in g and list(g).index(x) <= list(g).index(c) for c, of in g.items() for x in of)}
    for conv, g in graphs.items():
        if conv not in backward:
            assert got[conv] == brute_levels(g), conv


def test_rounds_grow_with_the_logarithm_of_a_chain(spark, monkeypatch):
    from ferrolake.llm import tool_calls
    names, real = [], tool_calls.stored
    monkeypatch.setattr(tool_calls, "stored", lambda spark, df, name: names.append(name) or real(spark, df, name))
    calls = [(1, 300 - i, f"c{i}", "f", '{"a":1}', [f"c{i - 1}"]) for i in range(300)]
    rows = linked_rows(spark, calls, [], group_calls=0)
    assert max(r.step for r in rows) == 299 and names.count("calls-chain") <= 11 and "calls-left" not in names


def test_odd_arguments_never_stop_the_job(spark):
    from ferrolake.llm.tool_calls import linked
    schema = {"f": {"type": "object", "properties": {"a": {"type": ["string", "null"]}, "n": {"type": "integer"}, "e": {"enum": [1, "x"]}}}}
    odd = {"deep": ("[" * 3000 + "]" * 3000, "malformed arguments"), "nested": ('{"a":' * 150 + "1" + "}" * 150, "$.a: not string or null"),
           "infinite": ('{"n": 1e999}', "malformed arguments"), "long": ('{"n": ' + "7" * 400 + "}", ""), "endless": ('{"n": ' + "7" * 9000 + "}", "malformed arguments"),
           "half": ('{"a": "\\ud800"}', ""), "key": ('{"\\udfff": 1}', ""), "null": ('{"a": null}', ""), "union": ('{"a": 5}', "$.a: not string or null"),
           "true": ('{"e": true}', "$.e: not in enum"), "one": ('{"e": 1.0}', ""), "float": ('{"n": 1.5}', "$.n: not integer")}
    calls = spark.createDataFrame([(1, i, k, "f", a, [], "x", 1) for i, (k, (a, _)) in enumerate(odd.items())], CALLS)
    rows = {r.call_id: r for r in linked(spark, calls, spark.createDataFrame([], RESULTS), schema).collect()}
    assert {k: r.errors for k, r in rows.items()} == {k: e for k, (_, e) in odd.items()}
    assert all(r.valid == (not r.errors) and json.loads(r.json)["id"] == k for k, r in rows.items())
    assert json.loads(rows["half"].json)["arguments"] == {"a": "\ud800"} and "\\ud800" in rows["half"].json


def test_schemas_with_unknown_keywords_are_refused(spark):
    from ferrolake.llm.tool_calls import checked
    for bad in ({"pattern": "x"}, {"properties": {"a": {"anyOf": []}}}, {"items": {"const": 1}}, {"type": "whole"}, {"additionalProperties": {}}):
        with pytest.raises(ValueError):
            checked(bad)
    checked({"type": ["object", "null"], "description": "d", "properties": {"a": {"type": "string", "default": "x"}}})


def test_messages_of_other_roles_are_kept(spark):
    from ferrolake.llm.tool_calls import CHAT_TOOLS, from_chat, linked
    turns = [(1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "yes"), (1, 3, None, None), (None, None, "tool", "x"), (2, None, "user", None)]
    rows = linked(spark, *from_chat(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))[:2], CHAT_TOOLS,
                  messages=from_chat(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))[2]).collect()
    assert Counter(r.status for r in rows) == {"message": 3, "answered": 1, "unanswered": 1}
    assert {(r.conv_id, r.turn, r.json) for r in rows if r.status == "message"} == {
        (1, 0, '{"content":"be brief","role":"system"}'), (1, 3, '{"content":null,"role":null}'), (None, None, '{"content":"x","role":"tool"}')}
