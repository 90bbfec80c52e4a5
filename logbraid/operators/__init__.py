"""DataFrame-to-DataFrame operators; they know keys, clocks and times, not log names."""
