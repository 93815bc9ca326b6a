"""Session presets sized to the machine, and the settings that every session of this library needs."""

from __future__ import annotations

import hashlib
import json
import math
import os
import platform
import tempfile
from dataclasses import dataclass

from pyspark.sql import SparkSession

GB = 1024**3
#: Settings that results depend on: partition values stay strings, times are UTC.
ALWAYS = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.sources.partitionColumnTypeInference.enabled": "false"}


@dataclass(frozen=True)
class Preset:
    name: str
    min_ram_gb: float
    columns_per_group: int
    write_partitions: int
    records_per_file: int
    advisory_mb: int
    broadcast: str
    fraction: float
    storage: float
    off_heap: str | None = None

    def conf(self) -> dict[str, str]:
        out = {"spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{self.advisory_mb}mb", "spark.sql.autoBroadcastJoinThreshold": self.broadcast, "spark.sql.files.maxRecordsPerFile": str(self.records_per_file), "spark.memory.fraction": str(self.fraction), "spark.memory.storageFraction": str(self.storage)}
        if self.off_heap:
            out |= {"spark.memory.offHeap.enabled": "true", "spark.memory.offHeap.size": self.off_heap}
        return out

    def static_conf(self) -> dict[str, str]:
        """Settings that only a new JVM takes."""
        return {k: v for k, v in self.conf().items() if k.startswith("spark.memory.")}

    def dynamic_conf(self) -> dict[str, str]:
        """Settings that a running session takes."""
        return {k: v for k, v in self.conf().items() if not k.startswith("spark.memory.")}

    def summary(self) -> str:
        return f"{self.name}: from {self.min_ram_gb:g} GB, {self.columns_per_group} columns a group, {self.write_partitions} write partitions, {self.records_per_file} records a file"


# The four presets.
PRESETS = {
    p.name: p
    for p in (
        Preset("SURVIVAL", 0, 50, 5, 500_000, 32, "-1", 0.6, 0.2, "512m"),
        Preset("BALANCED", 4, 100, 10, 1_000_000, 64, "-1", 0.6, 0.3, "1g"),
        Preset("PERFORMANCE", 16, 200, 20, 2_000_000, 128, "10mb", 0.75, 0.5),
        Preset("PRO", 32, 400, 40, 5_000_000, 256, "50mb", 0.8, 0.6),
    )
}


def preset_for(ram_gb: float) -> Preset:
    """The largest preset whose floor the memory reaches."""
    return max((p for p in PRESETS.values() if p.min_ram_gb <= max(0.0, ram_gb)), key=lambda p: p.min_ram_gb)


def preset_named(name: str) -> Preset:
    try:
        return PRESETS[name.upper()]
    except KeyError:
        raise ValueError(f"no preset {name!r}; there are {', '.join(PRESETS)}") from None


def downgrade(preset: Preset) -> Preset | None:
    """The next smaller preset, None below the smallest."""
    smaller = [p for p in PRESETS.values() if p.min_ram_gb < preset.min_ram_gb]
    return max(smaller, key=lambda p: p.min_ram_gb, default=None)


def parse_memory(text: str) -> float:
    """GB of a Spark memory string; a bare number is GB."""
    t = text.strip().lower().removesuffix("b")
    scale = {"t": 1024.0, "g": 1.0, "m": 1 / 1024, "k": 1 / 1024**2}
    return float(t[:-1]) * scale[t[-1]] if t[-1:] in scale else float(t)


def machine() -> dict:
    """Total and free memory in bytes, and cores."""
    info = {}
    try:
        with open("/proc/meminfo", encoding="ascii") as f:
            info = {k: int(v.split()[0]) * 1024 for k, v in (line.split(":") for line in f)}
    except OSError:
        pass
    total = info.get("MemTotal", os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES"))
    return {"total": total, "available": info.get("MemAvailable", total), "cores": os.cpu_count() or 1, "system": platform.system()}


def fingerprint(facts: dict) -> str:
    """16 hex digits of the SHA-256 of canonical JSON. Free memory is left out, so equal machines agree."""
    stable = {k: v for k, v in facts.items() if k != "available"}
    return hashlib.sha256(json.dumps(stable, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


def mode_conf(mode: str, memory: float, cores: int) -> dict[str, str]:
    """Settings by deployment: local has only a driver; clusters split memory between driver and executors."""
    usable = max(cores - 1, 1)
    if mode == "local":
        return {"spark.master": f"local[{usable}]", "spark.driver.memory": f"{math.floor(memory)}g", "spark.sql.shuffle.partitions": str(2 * usable)}
    if mode not in ("yarn", "k8s"):
        raise ValueError(f"no mode {mode!r}; there are local, yarn, k8s")
    # A quarter for the driver; of the rest, Spark's own overhead factor is on top of what an executor asks for.
    driver, executor = (int(max(part, 1.0) * 1024) for part in (memory / 4, memory * 2 / 3))
    out = {"spark.driver.memory": f"{driver}m", "spark.executor.memory": f"{executor}m", "spark.executor.cores": str(usable), "spark.sql.shuffle.partitions": str(4 * usable)}
    return out | ({"spark.master": "yarn"} if mode == "yarn" else {})


def build(mode: str = "local", memory: str = "2g", preset: Preset | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """A session of so much memory, with the preset that the machine's free memory allows."""
    m = machine()
    preset = preset or preset_for(m["available"] / GB)
    conf = mode_conf(mode, parse_memory(memory), m["cores"]) | preset.conf() | ALWAYS | (extra or {})
    builder = SparkSession.builder.appName("strataflow")
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Where it is unset, local mode takes a temporary one; a cluster has no
    folder that all its machines see, so that is an error there."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; it must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="strataflow-"))
    return sc._jsc.sc().getCheckpointDir().get()
