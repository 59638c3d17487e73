"""Servers for the sinks' tests: they keep what they get in a folder, which the address names, and fail as files there say."""

import json
import os
import uuid


def kept(url, headers, body):
    """Take documents; refuse for now while ``down`` is there, or as often as ``fail-N`` files are; refuse a document that says so for good."""
    folder = "/" + url.split("://")[1].split("/", 1)[1].rsplit("/_bulk", 1)[0].rsplit("/insert", 1)[0].rsplit("/health", 1)[0].strip("/")
    if os.path.exists(f"{folder}/down"):
        return 503, ""
    for name in sorted(os.listdir(folder)):
        if name.startswith("fail-"):
            try:
                os.remove(f"{folder}/{name}")
            except FileNotFoundError:
                continue
            return 502, ""
    if url.endswith("/health"):
        return 200, ""
    lines = body.decode().strip().split("\n")
    documents = lines[1::2] if "_bulk" in url else lines
    bad = ['"bad"' in d for d in documents]
    with open(f"{folder}/part-{uuid.uuid4().hex}", "w") as f:
        f.write("".join(f"{d}\n" for d, b in zip(documents, bad, strict=True) if not b))
    return 200, json.dumps({"items": [{"index": {"status": 400 if b else 201}} for b in bad]})


def documents(folder):
    return [json.loads(line) for name in os.listdir(folder) if name.startswith("part-") for line in open(f"{folder}/{name}")]
