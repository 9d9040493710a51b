"""Jobs chaining sources, operators and sinks, and the registered queries."""
