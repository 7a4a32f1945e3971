"""Reading and writing: event archives, rule and panel files, landed responses, sinks."""
