"""DataFrame → DataFrame operators of the three layers and the quality-check compiler."""
