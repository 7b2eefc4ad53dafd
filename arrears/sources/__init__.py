from .committed import commit, current_folder, manifest, vacuum_sink  # noqa: F401
from .invoices import invoices_from_tables, invoices_table, read_table  # noqa: F401
from .io import (  # noqa: F401
    infer_types,
    normalize_columns,
    read_invoices_csv,
    read_invoices_parquet,
    read_predictions,
    read_training_set,
    rejected_rows,
    write_invoices_csv,
    write_labelled_predictions,
    write_predictions,
    write_training_set,
)
