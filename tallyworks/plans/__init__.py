"""Jobs: what a scheduler calls. Each ties sources, operators and sinks together."""
