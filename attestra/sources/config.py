"""Where a base's inputs and outputs are: arguments first, then a TOML file, then defaults."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, fields
from pathlib import Path

#: The section of the file that holds the paths, and their defaults (null: not there).
SECTION = "rutas"
DEFAULTS = {"pdf": "datos/pdf", "salida": "salida", "semillas": "datos/semillas", "pads": "PADs", "anexos": "ANEXOS", "recursos_ra": None, "pdf_institucional": None, "poppler": None}
#: Outputs under `salida`.
OUTPUTS = {
    "pads_json": "pads.json", "anexos_json": "anexos.json", "recursos_ra_json": "recursos_ra.json", "pptx_json": "pptx.json", "ocr_json": "ocr.json", "diapositivas": "diapositivas.json",
    "data_json": "data.json", "csv": "csv", "csv_zip": "tablas_csv.zip", "compartir": "compartir", "pdf_convertidos": "pdf_convertidos", "base": "base", "tablero": "tablero.html",
}
#: The folder of the tools that read PDF files may come from the environment, which goes before the file.
TOOLS_VARIABLE = "ATTESTRA_POPPLER"


@dataclass(frozen=True)
class Paths:
    pdf: str
    salida: str
    semillas: str
    pads: str | None = None
    anexos: str | None = None
    recursos_ra: str | None = None
    pdf_institucional: str | None = None
    poppler: str | None = None

    def output(self, name: str) -> str:
        return f"{self.salida.rstrip('/')}/{OUTPUTS[name]}"


def _resolve(value: str | None, base: Path) -> str | None:
    """Paths with a scheme stay as they are; others are taken from the folder of the file."""
    return value if value is None or "://" in value else str((base / value).resolve())


def load(config: str | Path, **arguments: str | None) -> Paths:
    """The paths of a configuration file, which need not exist; arguments that are given go before it, from the working folder."""
    names = {f.name for f in fields(Paths)}
    if unknown := set(arguments) - names:
        raise ValueError(f"unknown paths {sorted(unknown)}")
    config = Path(config)
    told = tomllib.loads(config.read_text(encoding="utf-8")).get(SECTION, {}) if config.exists() else {}
    out = {name: _resolve(told.get(name, default), config.resolve().parent) for name, default in DEFAULTS.items()}
    out["poppler"] = os.environ.get(TOOLS_VARIABLE) or out["poppler"]
    return Paths(**out | {k: _resolve(v, Path.cwd()) for k, v in arguments.items() if v})
