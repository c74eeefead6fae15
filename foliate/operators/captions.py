"""Captions of figures: prompts from their surroundings, replies as outcomes, and a cache so that a picture is sent once.

The model is a plug-in: any object with ``caption(bytes, prompt) -> (text, finish_reason, ok)``, made in each task by a
factory. Pictures are reduced to their distinct keys before anything is sent, and the cache takes off what is known.
"""

from __future__ import annotations

import base64
import json
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.functions import text as fn
from foliate.session import written


class Captioner(Protocol):
    def caption(self, image: bytes, prompt: str) -> tuple[str, str, bool]: ...


def cache_key(image: Column | str, model: str = "", prompt: Column | None = None) -> Column:
    """The hash of the bytes that are sent, with the model's and the prompt's where they matter."""
    key = F.concat(F.lit("sha256:"), F.sha2(fn.col(image), 256))
    if prompt is None:
        return key
    return F.concat(key, F.lit(":"), F.substring(F.sha2(F.concat(F.lit(model + "\x00"), prompt), 256), 1, 12))


def classify_reply(text: Column | str) -> Column:
    """FURNITURE, OK or USELESS, in this order."""
    return F.when(fn.caption_is_furniture(text), "FURNITURE").when(fn.caption_is_useful(text), "OK").otherwise("USELESS")


def context(images: DataFrame, lines: DataFrame, radius: int = 12, most: int = 700) -> DataFrame:
    """(doc_id, image_id, line, nearby): the prose around each picture within its section.

    images(doc_id, image_id, line, line_start, line_end), lines(key, line, raw). An equi-join by document with the line
    range as its condition; a document's lines near its pictures only are gathered.
    """
    raw = fn.strip(F.col("l.raw"))
    prose = (raw != "") & ~raw.startswith("![") & ~raw.startswith("#") & ~raw.rlike(r"^[|\- ]+$")
    near = (F.col("l.line") >= F.greatest(F.col("i.line_start"), F.col("i.line") - radius)) & (F.col("l.line") < F.least(F.col("i.line_end"), F.col("i.line") + radius + 1))
    joined = images.alias("i").join(lines.alias("l"), (F.col("i.doc_id") == F.col("l.key")) & near & prose, "left")
    got = joined.groupBy(F.col("i.doc_id").alias("doc_id"), F.col("i.image_id").alias("image_id"), F.col("i.line").alias("line")).agg(F.array_sort(F.collect_list(F.struct(F.col("l.line").alias("n"), raw.alias("t")))).alias("a"))
    words = F.array_join(F.transform(F.filter("a", lambda x: x["n"].isNotNull()), lambda x: x["t"]), " ")
    return got.select("doc_id", "image_id", "line", F.substring(fn.squeeze(words), 1, most).alias("nearby"))


def prompt(base: str, domain: str, title: Column, path: Column, nearby: Column) -> Column:
    """The instruction, with the place of the figure in its document."""
    head = f"{domain.strip()}\n\n{base}" if domain.strip() else base
    part = lambda label, c: F.when(F.length(F.coalesce(c, F.lit(""))) > 0, F.concat(F.lit(f"\n- {label}: "), c)).otherwise("")
    note = "\n\nUse this place in the document to say what the figure is for; describe only what is visible:"
    return F.concat(F.lit(head + note), part("Document", title), part("Section", path), part("Surrounding text", nearby))


def caption_images(images: DataFrame, factory: Callable[[], Captioner], model: str, cache: DataFrame | None = None, attempts: int = 2) -> DataFrame:
    """(key, kind, caption, model, truncated): one row per distinct picture. images(image, prompt).

    A reply counts once it is genuine; what can't be had is UNAVAILABLE and is asked again by a later run.
    """
    asked = images.select(cache_key("image", model, F.col("prompt")).alias("key"), "image", "prompt").dropDuplicates(["key"])
    known = None
    if cache is not None:
        known = cache.join(asked.select("key"), "key", "left_semi").select("key", "kind", "caption", "model", "truncated")
        asked = asked.join(cache.select("key"), "key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = factory()
        for frame in batches:
            rows = []
            for key, image, text in zip(frame["key"], frame["image"], frame["prompt"]):
                reply, reason, ok = "", "", False
                for _ in range(attempts):
                    try:
                        got, why, fine = client.caption(bytes(image), text)
                    except Exception:  # the edge to an outside service
                        continue
                    ok = ok or fine
                    reply, reason = got or "", why
                    if ok and reply:
                        break
                rows.append((key, ok, reply, model, reason == "length"))
            yield pd.DataFrame(rows, columns=["key", "ok", "caption", "model", "truncated"])

    made = asked.mapInPandas(run, "key string, ok boolean, caption string, model string, truncated boolean")
    made = made.select("key", F.when(~F.col("ok"), "UNAVAILABLE").otherwise(classify_reply("caption")).alias("kind"), "caption", "model", "truncated")
    return made if known is None else made.unionByName(known)


def payload(image: bytes, kind: str, text: str, model: str, most_tokens: int) -> dict:
    """A chat request with a picture as a data address."""
    mime = {"jpg": "jpeg"}.get(kind, kind or "png")
    url = f"data:image/{mime};base64,{base64.b64encode(image).decode()}"
    return {"model": model, "max_tokens": most_tokens, "messages": [{"role": "user", "content": [{"type": "text", "text": text}, {"type": "image_url", "image_url": {"url": url}}]}]}


def summary(outcomes: DataFrame) -> DataFrame:
    """Counts of captions by kind per document."""
    n = lambda kind: F.count_if(F.col("kind") == kind)
    return outcomes.groupBy("doc_id").agg(F.countDistinct("image_id").alias("expected"), n("OK").alias("captioned"), n("FURNITURE").alias("furniture"), n("USELESS").alias("useless"), n("UNAVAILABLE").alias("pending"))


# ---- a service ------------------------------------------------------------------------------------------------------


def reply_of(answer: dict) -> tuple[str, str, bool]:
    """(text, finish reason, whether it is genuine) of a chat service's answer: the text, or where it is empty the reasoning."""
    choice = (answer.get("choices") or [{}])[0]
    message = choice.get("message") or {}
    text = (message.get("content") or "").strip()
    return text or (message.get("reasoning_content") or "").strip(), choice.get("finish_reason") or "", bool(answer.get("choices"))


def kind_of(image: bytes) -> str:
    """The kind of picture that is announced to the service."""
    heads = {b"\xff\xd8\xff": "jpeg", b"GIF": "gif", b"RIF": "webp"}
    return heads.get(image[:3], "png")


class ChatCaptioner:
    """A captioner over HTTP for services with a chat interface. Made in each task; what fails raises and is tried again by its caller."""

    def __init__(self, url: str, model: str, most_tokens: int = 8192, seconds: float = 120.0):
        self.url, self.model, self.most_tokens, self.seconds = url.rstrip("/"), model, most_tokens, seconds

    def _call(self, path: str, body: dict | None = None) -> dict:
        data = None if body is None else json.dumps(body).encode()
        request = urllib.request.Request(self.url + path, data=data, headers={"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=self.seconds) as answer:
            return json.loads(answer.read())

    def healthy(self) -> bool:
        """Whether the service answers and serves the model."""
        try:
            return self.model in {m.get("id") for m in self._call("/models").get("data", [])}
        except (OSError, ValueError):
            return False

    def caption(self, image: bytes, prompt: str) -> tuple[str, str, bool]:
        return reply_of(self._call("/chat/completions", payload(image, kind_of(image), prompt, self.model, self.most_tokens)))


# ---- a run over bundles ---------------------------------------------------------------------------------------------

ENTRIES = "doc_id string, image_id string, file string, line int, line_start int, line_end int, title string, path string"


def entries(structures: DataFrame) -> DataFrame:
    """ENTRIES of the pictures in structures(doc_id, structure): where each stands, with its section's titles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in ENTRIES.split(", ")]
        for frame in batches:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["structure"]):
                stack = [((), n) for n in reversed(json.loads(text)["outline"])]
                while stack:
                    above, node = stack.pop()
                    titles = (*above, node["title"])
                    rows += [(doc_id, i["image_id"], i["ref"].rpartition("/")[2], i["line"], *node["line_span"], titles[0], " > ".join(titles)) for i in node["images"] if i["ref"].startswith("images/")]
                    stack += [(titles, c) for c in reversed(node["children"])]
            yield pd.DataFrame(rows, columns=names)

    return structures.select("doc_id", "structure").mapInPandas(run, ENTRIES)


def caption_bundles(spark: SparkSession, out: str, factory: Callable[[], Captioner], model: str, base: str, domain: str = "") -> DataFrame:
    """(doc_id, expected, captioned, furniture, useless, pending, gate): captions the pictures of all bundles below `out`.

    Distinct (picture, prompt) pairs are sent once; genuine replies are kept in the table captions.parquet below `out`,
    so a further run sends only what is new or could not be had. Captions go into structure.json and the captions block
    of report.json; nothing else of a bundle is touched. Pictures are joined by their hash names; bytes are read beside
    the prompts and go no further than to the service.
    """
    from foliate.operators import bundle

    root = out.rstrip("/")
    read = lambda glob: spark.read.format("binaryFile").load(f"{root}/*/{glob}").select(F.element_at(F.split("path", "/"), -2).alias("last"), F.element_at(F.split("path", "/"), -3).alias("before"), F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    text = F.decode("content", "UTF-8")
    structures = read("structure.json").select(F.col("last").alias("doc_id"), text.alias("structure"))
    bodies = read("document.md").select(F.col("last").alias("doc_id"), F.regexp_replace(fn.strip_front_matter(text), r"^\n", "").alias("body"))
    found = written(entries(structures), "caption-entries")
    shown = found.select("doc_id").distinct()
    lines = bodies.join(shown, "doc_id", "left_semi").select(F.col("doc_id").alias("key"), F.posexplode(F.split("body", "\n", -1)).alias("line", "raw"))
    places = context(found, lines).join(found, ["doc_id", "image_id", "line"]).dropDuplicates(["doc_id", "image_id"])
    asked = places.select("doc_id", "image_id", "file", prompt(base, domain, F.col("title"), F.col("path"), F.col("nearby")).alias("prompt"))
    pictures = read("images/*").select(F.col("before").alias("doc_id"), F.col("name").alias("file"), F.col("content").alias("image"))
    rows = asked.join(pictures, ["doc_id", "file"])
    keys = written(rows.select("doc_id", "image_id", cache_key("image", model, F.col("prompt")).alias("key")), "caption-keys")
    store = f"{root}/captions.parquet"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    cache = spark.read.parquet(store).dropDuplicates(["key"]) if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path) else None
    made = written(caption_images(rows.select("image", "prompt"), factory, model, cache), "captions-made")
    fresh = made.where("kind != 'UNAVAILABLE'")
    (fresh if cache is None else fresh.join(cache.select("key"), "key", "left_anti")).write.mode("append").parquet(store)
    got = keys.join(made, "key").groupBy("doc_id").agg(F.collect_list(F.struct("image_id", "kind", "caption")).alias("found"))  # a document's own pictures

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for doc_id, outcomes in zip(frame["doc_id"], frame["found"]):
                folder = bundle.Folder(root, doc_id)
                structure, report = (json.loads(folder.get(n)) for n in ("structure.json", "report.json"))
                by = {o["image_id"]: (o["kind"], o["caption"]) for o in outcomes}
                seen = {}
                for entry in bundle.pictures_in(structure["outline"]):
                    kind, caption = by.get(entry["image_id"], ("UNAVAILABLE", ""))
                    if kind == "OK":
                        entry["caption"] = caption
                    elif kind != "UNAVAILABLE":
                        entry["caption"] = None
                    seen[entry["image_id"]] = "OK" if entry["caption"] else kind
                count = lambda kind: sum(k == kind for k in seen.values())  # noqa: B023, E731
                block = bundle.caption_block(True, len(seen), count("OK"), count("FURNITURE"), count("USELESS"))
                report["captions"] = block | {"model": model}
                folder.put("structure.json", bundle._json(structure))
                folder.put("report.json", bundle._json(report))
                rows.append((doc_id, *(block[k] for k in ("expected", "captioned", "furniture", "useless", "pending", "gate"))))
            yield pd.DataFrame(rows, columns=["doc_id", "expected", "captioned", "furniture", "useless", "pending", "gate"])

    return written(got.mapInPandas(run, "doc_id string, expected bigint, captioned bigint, furniture bigint, useless bigint, pending bigint, gate string"), "caption-runs")
