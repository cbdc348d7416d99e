"""Inline transforms that are known, by the SHA-256 of their normalised code with its literals cut out."""

#: Fixed values.
KNOWN = {
    "86a99a9f56c1f6257764decb85d1811895fcb879a0290da13d0b004179285216": "avro_events",
    "bb4167ca7d45088cdfbb9c6b81ee6c44f2107319b54f72a98ec1b92595ce73b9": "cloudevents",
    "4cd1436685d9820370c83b0fbe2a8a46e9741ea609313c704772c9bd980a1c5e": "cloudevents_enriched",
    "57f12101cba7361e61a64b92a49571f474cde2ada61574d09fb89970d9238210": "debezium_unwrap",
    "ac0528445757488dbe9e2d849eaa0b9baa48954303a2a8fb0b26e37341b48c70": "json_cdc",
    "bb521b15a3b16c984f1941857f9c9ebaa512024a5f4d2afc0386dbb489d6bb99": "json_events",
}
