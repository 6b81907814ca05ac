"""Column-level functions: addresses, frames, headers, layouts, time stamps."""
