"""DataFrame operators: frames in, frames out."""
