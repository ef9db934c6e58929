"""Reason codes. Labels and reports that others have stored carry these texts and are compared with them as
texts, so their wording must stay as it is."""

# of commands
COMMAND_IDENTITY_CHANGED = "command_identity_changed"
CANONICAL_SOURCE_ORDER_NOT_STRICTLY_INCREASING = "canonical_source_order_not_strictly_increasing"
UNSUPPORTED_COMMAND_FLAGS = "unsupported_command_flags"
BUTTON_PROJECTION_MISMATCH = "button_projection_mismatch"
ACTION_EVENT_NOT_A_TRANSITION = "action_event_not_a_transition"
ACTION_EVENTS_OUT_OF_ORDER = "action_events_out_of_order"
#: Behind the name of a generation clock.
OUTSIDE_MEASURED_GENERATION_CADENCE = "_outside_measured_generation_cadence"

# of states
ALIVE_NOT_TRUE = "alive_not_true"
PAUSE_UNKNOWN = "pause_unknown"
PAUSE_ACTIVE = "pause_active"

# of controls
SOURCE_NORMALIZATION_PREDECESSOR_DISAGREES = "source_normalization_predecessor_disagrees"
SOURCE_FIRST_TARGET_DISAGREES = "source_first_target_disagrees"
CONTROL_WINDOW_EXCEEDS_VERIFIED_SOURCE_HORIZON = "control_window_exceeds_verified_source_horizon"
CONTRIBUTING_LIVE_SOURCE_ENVELOPE_UNAVAILABLE_OR_AMBIGUOUS = "contributing_live_source_envelope_unavailable_or_ambiguous"
COMPLETE_CONTROL_WINDOW_UNAVAILABLE = "complete_control_window_unavailable"
CONTROL_STATE_WINDOW_OUT_OF_SUPPORTED_RANGE = "control_state_window_out_of_supported_range"

# of summaries
INCOMPLETE_COMMAND_RECONSTRUCTION = "incomplete_command_reconstruction"
AMBIGUOUS_COMMAND_NUMBER_IDENTITY = "ambiguous_command_number_identity"
CANONICAL_COMMAND_PROJECTION_REQUIRES_REVIEW = "canonical_command_projection_requires_review"

# of insertions
EARLY_SCHEDULING_OBSERVATION = "early_scheduling_observation"
MISSING_OR_AMBIGUOUS_NATIVE_FRAME = "missing_or_ambiguous_native_frame"
INSERTION_COUNT_DISAGREES = "insertion_count_disagrees"
INSERTION_CLOCK_REVERSED = "insertion_clock_reversed"

# of effects
AMMO_OR_WEAPON_IDENTITY_UNAVAILABLE_OR_CHANGED = "ammo_or_weapon_identity_unavailable_or_changed"
MOVEMENT_STATE_UNAVAILABLE = "movement_state_unavailable"
JUMP_STATE_UNAVAILABLE = "jump_state_unavailable"
DUCK_STATE_UNAVAILABLE = "duck_state_unavailable"

# of samples
HISTORY_NOT_CONTIGUOUS = "history_not_contiguous"
TARGET_UNAVAILABLE = "target_unavailable"
AMBIGUOUS_COMMAND_SUPPORT = "ambiguous_command_support"
