"""A 41-file collection with planted errors, built from the standard library."""

from __future__ import annotations

import os
import zipfile
import zlib
from datetime import datetime, timezone

from ledgerfold.plans.derived import _package

ROOT_NAME = "sample-intake"
NORMAL = datetime(2026, 4, 1, 9, 0, tzinfo=timezone.utc)

# --- fixed values: custodian rules of the collection, in order ---------------
RULES = [
    ("Reports/RPT-2026-Q1_Financials.xlsx", "P. Bautista (Finance)"),
    ("data_export.csv", "ERP Export (non-custodial source)"),
    ("Invoices/*", "M. Santos (Accounts Payable)"),
    ("Correspondence/*", "R. Dimalanta (Project Management)"),
    ("Contracts/*", "K. Aguilar (Legal)"),
    ("Reports/*", "L. Ferrer (Operations)"),
    ("Site Photos/*", "Field Tablet 02 (Site Ops)"),
]

DANA, JORGE, VILLA, ALIA, SAM = "Dana Cruz", "Jorge Reyes", "M. Villanueva", "Alia Tan", "Sam Ocampo"
DEEP = "Old Files/2019 archive/deep/nested"

# --- fixed values: path, author, accepted labels (none: nothing to read) -----
FILES = [
    ("Invoices/INV-2026-001_AcmeSupply.pdf", JORGE, "invoice"),
    ("Invoices/INV-2026-002_AcmeSupply.pdf", JORGE, "invoice"),
    ("Invoices/INV-2026-003_BrightWorks.pdf", ALIA, "invoice"),
    ("Invoices/inv 2026-004 brightworks FINAL.pdf", ALIA, "invoice"),
    ("Invoices/INV-2026-005_AcmeSupply.pdf", JORGE, "invoice"),
    ("Invoices/INV-2026-005_AcmeSupply (1).pdf", JORGE, "invoice"),
    ("Invoices/INV-2026-006_DeltaFreight.PDF", SAM, "invoice"),
    ("Invoices/INV-2026-007_DeltaFreight.pdf", SAM, "invoice"),
    ("Invoices/INV-2026-008_BrightWorks.pdf", ALIA, "invoice"),
    ("Invoices/INV-2026-009_AcmeSupply.pdf", JORGE, "invoice"),
    ("Invoices/invoice_batch_Q2.xlsx", DANA, "invoice other"),
    ("Contracts/CTR-2026-01_ServiceAgreement_AcmeSupply.docx", DANA, "contract"),
    ("Contracts/CTR-2026-02_NDA_BrightWorks.docx", DANA, "contract"),
    ("Contracts/CTR-2026-02_NDA_BrightWorks_v2.docx", DANA, "contract"),
    ("Contracts/CTR-2026-03_MSA_DeltaFreight.pdf", DANA, "contract"),
    ("Contracts/Contract FINAL FINAL (use this one).docx", DANA, "contract"),
    ("Contracts/scan_001.pdf", None, "contract"),
    ("Correspondence/2026-03-14_AcmeSupply_kickoff.pdf", None, "correspondence"),
    ("Correspondence/2026-03-15_AcmeSupply_followup.pdf", None, "correspondence"),
    ("Correspondence/2026-04-02_BrightWorks_scope_change.pdf", ALIA, "correspondence"),
    ("Correspondence/RE RE FW Important!!.pdf", None, "correspondence"),
    ("Correspondence/memo_draft.docx", None, ""),
    ("Reports/RPT-2026-Q1_Operations.pdf", VILLA, "report"),
    ("Reports/Copy of RPT-2026-Q1_Operations.pdf", VILLA, "report"),
    ("Reports/RPT-2026-Q2_Operations_DRAFT.docx", VILLA, "report"),
    ("Reports/RPT-2026-Q1_Financials.xlsx", VILLA, "report"),
    ("Site Photos/site_photo_01.png", None, ""),
    ("Site Photos/site_photo_02.png", None, ""),
    ("Site Photos/site_photo_02 - Copy.png", None, ""),
    ("Site Photos/site_photo_03.png", None, ""),
    ("Site Photos/IMG_3847.jpg", None, ""),
    ("notes.txt", None, "correspondence other"),
    ("data_export.csv", None, "other"),
    ("report_final.pdf", None, "report"),
    ("empty_placeholder.pdf", None, ""),
    ("~$ntract_temp.docx", None, "other"),
    ("Thumbs.db", None, ""),
    ("old_backup.zip", None, ""),
    (f"{DEEP}/legacy_notes.doc", None, "other"),
    (f"{DEEP}/misc_scan_0042.pdf", None, "other"),
    (f"{DEEP}/RPT-2031_forecast.pdf", VILLA, "report"),
]

# --- fixed values: planted errors by type -------------------------------------
SEEDED = {
    "exact-duplicate": [
        "Invoices/INV-2026-005_AcmeSupply.pdf",
        "Invoices/INV-2026-005_AcmeSupply (1).pdf",
        "Reports/RPT-2026-Q1_Operations.pdf",
        "Reports/Copy of RPT-2026-Q1_Operations.pdf",
        "Site Photos/site_photo_02.png",
        "Site Photos/site_photo_02 - Copy.png",
    ],
    "near-duplicate-name": [
        "Contracts/CTR-2026-02_NDA_BrightWorks.docx",
        "Contracts/CTR-2026-02_NDA_BrightWorks_v2.docx",
    ],
    "naming-violation": [
        "Invoices/inv 2026-004 brightworks FINAL.pdf",
        "Invoices/INV-2026-006_DeltaFreight.PDF",
        "Contracts/Contract FINAL FINAL (use this one).docx",
        "Contracts/scan_001.pdf",
        "Correspondence/RE RE FW Important!!.pdf",
        "report_final.pdf",
    ],
    "extension-mismatch": ["Site Photos/IMG_3847.jpg", "report_final.pdf", f"{DEEP}/legacy_notes.doc"],
    "zero-byte": ["Correspondence/memo_draft.docx", "empty_placeholder.pdf"],
    "date-anomaly": [f"{DEEP}/legacy_notes.doc", f"{DEEP}/RPT-2031_forecast.pdf"],
    "junk-file": ["~$ntract_temp.docx", "Thumbs.db"],
    "archive": ["old_backup.zip"],
    "deep-nesting": [f"{DEEP}/misc_scan_0042.pdf"],
}

COPIES = {
    "Invoices/INV-2026-005_AcmeSupply (1).pdf": "Invoices/INV-2026-005_AcmeSupply.pdf",
    "Reports/Copy of RPT-2026-Q1_Operations.pdf": "Reports/RPT-2026-Q1_Operations.pdf",
    "Site Photos/site_photo_02 - Copy.png": "Site Photos/site_photo_02.png",
}
PLAIN_TEXT = (".txt", ".csv", ".doc")
EMPTY = {"Correspondence/memo_draft.docx", "empty_placeholder.pdf"}


def document_words(path: str, labels: str) -> str:
    return f"This document is plainly of the kind {labels.split()[0]}; its subject: {path}"


def pdf(text: str, author: str | None) -> bytes:
    lines = " T* ".join(f"({line})Tj" for line in text.replace("(", r"\(").replace(")", r"\)").split("\n"))
    stream = zlib.compress(f"BT /F1 11 Tf 72 700 Td 14 TL {lines} ET".encode("latin-1"))
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        b"<< /Type /Pages /Kids [3 0 R] /Count 1 >>",
        b"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 612 792] /Contents 4 0 R "
        b"/Resources << /Font << /F1 << /Type /Font /Subtype /Type1 /BaseFont /Helvetica >> >> >> >>",
        b"<< /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(stream), stream),
        f"<< /Author ({author or ''}) >>".encode(),
    ]
    out, offsets = b"%PDF-1.4\n", []
    for number, body in enumerate(objects, 1):
        offsets.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (number, body)
    table = b"".join(b"%010d 00000 n \n" % at for at in offsets)
    return out + b"xref\n0 6\n0000000000 65535 f \n%strailer\n<< /Size 6 /Root 1 0 R /Info 5 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (
        table,
        len(out),
    )


def read_pdf(data) -> tuple[str, str | None]:
    """Text and author of a PDF that pdf() has made; stands for the reader a user brings."""
    raw = data.read()
    stream = zlib.decompress(raw.split(b"stream\n", 1)[1].split(b"\nendstream", 1)[0]).decode("latin-1")
    lines = [part.rsplit(")Tj", 1)[0] for part in stream.split("14 TL (", 1)[1].split(" T* (")]
    author = raw.split(b"/Author (", 1)[1].split(b")", 1)[0].decode()
    return "\n".join(lines).replace("\\(", "(").replace("\\)", ")"), author


READERS = {"pdf": read_pdf}


def png(shade: int) -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        return len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")

    rows = b"".join(b"\x00" + bytes([shade] * 12) for _ in range(4))
    header = b"\x00\x00\x00\x04\x00\x00\x00\x04\x08\x02\x00\x00\x00"
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def content(path: str, author: str | None, labels: str) -> bytes:
    name = path.rsplit("/", 1)[-1]
    extension = os.path.splitext(name)[1].lower()
    text = document_words(path, labels) if labels else ""
    if path in EMPTY:
        return b""
    if name == "Thumbs.db":
        return b"\xd0\xcf\x11\xe0thumbnails"
    if extension in (".png", ".jpg"):
        return png(sum(path.encode()) % 256)
    if extension in PLAIN_TEXT or name in ("report_final.pdf", "~$ntract_temp.docx"):
        return text.encode()
    if extension == ".pdf":
        return pdf(text, author)
    if extension == ".zip":
        return b""
    return _package(extension, text, author or "")


def build(folder) -> str:
    """Write the collection below a folder and return its root."""
    root = os.path.join(folder, ROOT_NAME)
    for path, author, labels in FILES:
        file = os.path.join(root, path)
        os.makedirs(os.path.dirname(file), exist_ok=True)
        source = COPIES.get(path, path)
        if path == "old_backup.zip":
            with zipfile.ZipFile(file, "w") as archive:
                archive.writestr("old_drive/vendors.txt", "vendors")
                archive.writestr("old_drive/minutes.txt", "minutes")
        else:
            with open(file, "wb") as out:
                out.write(content(source, author, labels))
        when = NORMAL
        if path.endswith("legacy_notes.doc"):
            when = datetime(1980, 5, 12, 9, 30, tzinfo=timezone.utc)
        if path.endswith("RPT-2031_forecast.pdf"):
            when = datetime(2031, 1, 15, 12, 0, tzinfo=timezone.utc)
        os.utime(file, (when.timestamp(), when.timestamp()))
    return root


def answer_key() -> dict:
    full = {path: f"{ROOT_NAME}/{path}" for path, *_ in FILES}
    return {
        "generated": "2026-07-21T00:00:00",
        "file_count": len(FILES),
        "files": sorted(full.values()),
        "seeded_errors": [
            {"type": kind, "paths": [full[p] for p in paths], "note": ""} for kind, paths in SEEDED.items()
        ],
        "authors": {full[p]: author for p, author, _ in FILES},
        "classes": {full[p]: labels.split() or None for p, _, labels in FILES},
    }
