"""DataFrame operators over cells (run_id, variable, member, step_h, i, j, lat, lon, value), axes and runs."""
