"""Job plans: the daily command set (R33) and the replay backfill."""
