"""Test double of a key-value client: records commands as JSON lines in a folder, and reads the last state back."""

import json
import os
import uuid


class LogClient:
    def __init__(self, url):
        os.makedirs(url, exist_ok=True)
        self.path, self.seq = os.path.join(url, uuid.uuid4().hex), 0

    def write_batch(self, commands):
        self.seq += 1
        with open(f"{self.path}-{self.seq:05d}.jsonl", "w") as fh:
            fh.writelines(json.dumps(c) + "\n" for c in commands)

    def create_index(self, name, prefix, schema):
        with open(os.path.join(os.path.dirname(self.path), "index.json"), "w") as fh:
            json.dump([name, prefix, schema], fh)

    def close(self):
        pass


def commands(url):
    """Batches in the order in which they were written."""
    names = sorted((f for f in (os.listdir(url) if os.path.isdir(url) else ()) if f.endswith(".jsonl")), key=lambda f: os.stat(os.path.join(url, f)).st_mtime_ns)
    return [[json.loads(x) for x in open(os.path.join(url, f))] for f in names]


def state(url):
    out = {}
    for batch in commands(url):
        for op, key, *rest in batch:
            if op == "hset":
                out.setdefault(key, {}).update(rest[0])
            elif op == "hdel":
                for field in rest[0]:
                    out[key].pop(field, None)
            elif op == "json_set":
                out[key] = rest[0]
            elif op == "del":
                out.pop(key, None)
    return out


def read(spark, url):
    """A reader for the job: (key, fields)."""
    rows = list(state(url).items())
    if rows and isinstance(rows[0][1], str):
        return spark.createDataFrame(rows, "key string, doc string")
    return spark.createDataFrame(rows, "key string, fields map<string,string>")
