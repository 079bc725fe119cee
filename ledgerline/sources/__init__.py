from ledgerline.sources.catalog import (
    declare_table,
    drop_old_loads,
    insert_rows,
    inline_table,
    read_table,
    register_view,
    replace_table,
    run_query,
)
from ledgerline.sources.incremental import copy_incremental, read_copied
from ledgerline.sources.inference import infer_csv, read_csv_as_text, read_csv_inferred
from ledgerline.sources.readers import read_csv, read_parquet
from ledgerline.sources.transfer import (
    copy_csv,
    file_metadata,
    fingerprints,
    read_text_cells,
    row_differences,
    verify_copy,
)
from ledgerline.sources.versioned import (
    VersionConflict,
    create_versioned,
    forget_versions,
    merge_rows,
    read_versioned,
    version_of,
    versions,
)
from ledgerline.sources.writers import write_csv, write_parquet

__all__ = [
    "VersionConflict",
    "copy_csv",
    "copy_incremental",
    "create_versioned",
    "declare_table",
    "drop_old_loads",
    "file_metadata",
    "fingerprints",
    "forget_versions",
    "infer_csv",
    "inline_table",
    "insert_rows",
    "merge_rows",
    "read_copied",
    "read_csv",
    "read_csv_as_text",
    "read_csv_inferred",
    "read_parquet",
    "read_table",
    "read_text_cells",
    "read_versioned",
    "register_view",
    "replace_table",
    "row_differences",
    "run_query",
    "verify_copy",
    "version_of",
    "versions",
    "write_csv",
    "write_parquet",
]
