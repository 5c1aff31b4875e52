"""The served-model extractor against a stub service; backoff; the cache of answers."""

import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from kgspark.config import Settings
from kgspark.operators import extract
from kgspark.operators.served import Capabilities, ServedModel, capabilities, extractor_factory


class Service(BaseHTTPRequestHandler):
    seen: list = []
    busy: dict = {}

    def do_POST(self):  # noqa: N802
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        prompt = body["messages"][1]["content"]
        Service.seen.append((self.path, self.headers["Authorization"], body))
        code = 200
        if prompt.startswith("busy") and Service.busy.setdefault(prompt, 0) < 2:
            Service.busy[prompt] += 1
            code = 429
        if prompt.startswith("bad"):
            code = 400
        if prompt.startswith("down"):
            code = 503
        self.send_response(code)
        self.end_headers()
        if code == 200:
            self.wfile.write(json.dumps({"choices": [{"message": {"content": f"answer to {prompt}"}}]}).encode())

    def log_message(self, *a):
        pass


@pytest.fixture(scope="module")
def url():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/v1/"
    server.shutdown()


def test_request_and_answer(url, monkeypatch):
    monkeypatch.setenv("KGSPARK_API_KEY", "k1")
    m = ServedModel(url, "deepseek-chat", schema={"type": "object"})
    assert m(["one", "two"]) == ["answer to one", "answer to two"] and m(["down"]) == [None]
    path, key, body = next(s for s in Service.seen if s[2]["messages"][1]["content"] == "one")
    assert path == "/v1/chat/completions" and key == "Bearer k1" and body["model"] == "deepseek-chat" and body["temperature"] == 0.1
    assert body["response_format"]["type"] == "json_schema" and body["response_format"]["json_schema"]["strict"] is False and body["thinking"] == {"type": "disabled"}
    assert "response_format" not in ServedModel(url, "qwen2").body("x") and ServedModel(url, "other").body("x")["response_format"] == {"type": "json_object"}
    with pytest.raises(ValueError, match="400"):
        m(["bad"])
    assert ServedModel("http://127.0.0.1:1", "m")(["x"]) == [None]


def test_capabilities():
    assert capabilities("GPT-4o").strict and not capabilities("deepseek-chat").strict and capabilities("qwen-plus").json_object
    assert capabilities("qwen2.5").fenced and capabilities("mine") == Capabilities() == capabilities("x", ())


def test_busy_services_are_asked_again(spark, url):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(["busy 1", "fine", "down", "busy 2"])], "i long, p string").coalesce(1)
    out = {r["i"]: (r["output"], r["score"]) for r in extract.extract(df, ["i"], "p", extractor_factory(Settings(model_url=url, model="m")), retries=3, wait=0.01).collect()}
    assert out == {0: ("answer to busy 1", 1.0), 1: ("answer to fine", 1.0), 2: ("", 0.0), 3: ("answer to busy 2", 1.0)}
    with pytest.raises(Exception, match="refuses"):
        extract.extract(df.select("i", F.lit("bad").alias("p")), ["i"], "p", extractor_factory(Settings(model_url=url, model="m")), wait=0.01).collect()
    with pytest.raises(ValueError):
        extractor_factory(Settings())
    assert extractor_factory(Settings(), {"A": ["x"]})()(["x y"]) == ['{"extractions": [{"A": "x"}]}']


def test_answers_are_kept(spark, url, tmp_path):
    cache = extract.AnswerCache(spark, str(tmp_path / "answers"))
    df = spark.createDataFrame([(1, "kept a", "ka"), (2, "kept b", "kb"), (3, "kept a", "ka"), (4, "down c", "kc")], "i long, p string, k string")
    make = extractor_factory(Settings(model_url=url, model="m"))
    ask = lambda: {r["i"]: (r["output"], r["score"]) for r in cache.extract(df, ["i"], "p", "k", make, retries=1).collect()}
    count = lambda t: sum(s[2]["messages"][1]["content"] == t for s in Service.seen)
    want = {1: ("answer to kept a", 1.0), 2: ("answer to kept b", 1.0), 3: ("answer to kept a", 1.0), 4: ("", 0.0)}
    assert cache.read().count() == 0
    assert ask() == want and (count("kept a"), count("kept b"), count("down c")) == (1, 1, 1)
    assert ask() == want and (count("kept a"), count("kept b"), count("down c")) == (1, 1, 2) and cache.read().count() == 2
    cache.clear()
    assert cache.read().count() == 0
