"""Writers: partition publishing, staging, metrics log, audit tables, schema baselines."""
