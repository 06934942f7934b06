"""Settings of a mining run, with presets."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields, replace
from pathlib import Path

BY_SEGMENT = ("dedup", "lid", "keep_lang", "sp", "lm", "pp_bucket", "minify", "split_by_segment")
DEFAULT_PIPELINE = ("dedup", "lid", "keep_lang", "sp", "lm", "pp_bucket", "drop", "split_by_lang")


@dataclass(frozen=True)
class Config:
    """Settings of a run.

    ``num_shards`` slices the manifest, ``num_segments_per_shard`` bounds a slice (negative: all); ``hash_in_mem`` shards share hashes (0: all);
    ``pipeline`` lists steps in order; ``metadata`` is the folder that ``fetch_metadata`` joins, ``cutoff`` a table of percentiles; files of
    ``target_size`` come out of regrouping, after which the input goes if ``cleanup_after_regroup``.
    """

    config_name: str = "base"
    dump: str = "2017-51"
    output_dir: str = "data"
    mined_dir: str = "mined"
    num_shards: int = 1600
    num_segments_per_shard: int = -1
    metadata: str | None = None
    min_len: int = 300
    hash_in_mem: int = 50
    lang_whitelist: tuple[str, ...] = ()
    lang_blacklist: tuple[str, ...] = ()
    lang_threshold: float = 0.5
    keep_bucket: tuple[str, ...] = ()
    lm_languages: tuple[str, ...] | None = None
    cutoff: str | None = None
    target_size: str = "4G"
    cleanup_after_regroup: bool = True
    pipeline: tuple[str, ...] = DEFAULT_PIPELINE

    @classmethod
    def from_json(cls, path: str | Path) -> Config:
        """Settings from JSON in which lines that start with ``//`` are comments; settings of schedulers and caches are ignored."""
        lines = [x for x in Path(path).read_text().splitlines() if not x.strip().startswith("//")]
        given = json.loads("\n".join(lines))
        known = {f.name for f in fields(cls)}
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in known})

    def wants_model(self, language: str) -> bool:
        """Whether documents of a language are to be scored by a language model."""
        if self.lm_languages is not None:
            return language in self.lm_languages
        if self.lang_whitelist:
            return language in self.lang_whitelist
        return language not in self.lang_blacklist

    def folder(self, stage: str = "") -> str:
        """Where a stage of the run keeps its files (``hashes``, ``split``, ``models``); without one, its result."""
        return "/".join([self.output_dir, f"{self.mined_dir}.{stage}" if stage else self.mined_dir, self.dump])


#: The presets below have the values of the surveyed toolkit (fixed values).
BASE = Config()
TEST = replace(
    BASE,
    config_name="test",
    dump="2019-09",
    output_dir="test_data",
    num_shards=4,
    num_segments_per_shard=1,
    hash_in_mem=2,
    lang_whitelist=("de", "it", "fr"),
    target_size="32M",
    cleanup_after_regroup=False,
)
PRESETS = {
    "base": BASE,
    "by_lang": replace(BASE, config_name="by_lang", mined_dir="mined_by_lang"),
    "test": TEST,
    "debug": replace(TEST, config_name="debug"),
    "reproduce": replace(
        BASE,
        config_name="reproduce",
        dump="2019-09",
        mined_dir="reproduce",
        pipeline=("fetch_metadata", "keep_lang", "keep_bucket", "split_by_lang"),
        lang_whitelist=("fr",),
        keep_bucket=("head", "all"),
    ),
    "augment": replace(BASE, config_name="augment", dump="2019-13", lang_blacklist=("en",)),
    "test_segment": replace(TEST, config_name="test_segment", mined_dir="mined_by_segment", pipeline=BY_SEGMENT),
    "test_reproduce": replace(TEST, config_name="test_reproduce", mined_dir="reproduce", metadata="test_data/mined_by_segment/2019-09", lang_whitelist=(), pipeline=("fetch_metadata", "split_by_lang")),
    "lid_exp": replace(BASE, config_name="lid_exp", dump="2019-09", mined_dir="lid_exp", pipeline=("lid_before_dedup", "dedup", "lid_after_dedup")),
    "mine_segment": replace(BASE, config_name="mine_segment", dump="2019-09", mined_dir="mini_by_segment", pipeline=BY_SEGMENT),
}
