"""The conversion as a stream."""
