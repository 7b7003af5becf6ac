"""Source schemas and target column lists."""

from __future__ import annotations

from pyspark.sql import types as T


_SETTING_FLAGS = [
    "100_profit_split",
    "2_percent_lower_target",
    "2_percent_more_daily_drawdown",
    "2_percent_more_max_drawdown",
    "allow_expert_advisors",
    "close_all_positions_on_friday",
    "double_leverage",
    "held_over_the_weekend",
    "no_sl_required",
    "requires_stop_loss",
    "requires_take_profit",
    "visible_on_leaderboard",
]
_SETTING_SPANS = [
    "delete_account_after_failure",
    "inactivity_breach_trigger",
    "max_time_per_evaluation_phase",
    "max_time_per_funded_phase",
    "min_time_per_phase",
    "time_between_withdrawals",
    "withdraw_within",
]

# Column definitions of the source tables.
SOURCES: dict[str, str] = {
    "users": (
        "id bigint, username string, password string, reset_pass_hash string, firstname string,"
        " lastname string, phone string, phone_verified int, role int, active int, ref_by_user_id bigint,"
        " ref_link_clicks int, sent_activation_mail_count int, address string, country string, state string,"
        " city string, zip string, timezone string, `2fa_sms_enabled` int, identity_status string,"
        " identity_verified_at string, accept_affiliate_terms int, dashboard_popup int, discord_connected int,"
        " used_free_count int, available_count int, google_app_secret string, is_google_app_verify int,"
        " trail_verification_status int, ref_code string, last_login timestamp_ntz, created_at timestamp_ntz"
    ),
    "discount_codes": (
        "id bigint, code string, status string, max_usages_count int, current_usages_count int, discount double,"
        " discount_code_end_date timestamp_ntz, group_name string, account_balance string,"
        " challenge_amount string, email string, challenge_step string, created_date timestamp_ntz,"
        " last_modified_date timestamp_ntz"
    ),
    "purchases": (
        "id bigint, user_id bigint, amount_total double, currency string, payment_method string,"
        " payment_status int, is_paid_aff_commission int, user_data string, created_at timestamp_ntz,"
        " original_amount double, discount double, discount_code string, discount_id bigint, already_paid int,"
        " payment_transaction_id string, payment_response string, payment_attempt_count int"
    ),
    "platform_groups": (
        "uuid string, name string, group_type string, platform_name string, account_stage string,"
        " account_type string, initial_balance double, funded_group_name string"
    ),
    "accounts": (
        "login string, user_id bigint, purchase_id bigint, `group` string, funded_at timestamp_ntz, is_active int,"
        " action_type string, initial_balance bigint, target double, profit_split double, max_drawdown double,"
        " max_daily_drawdown double, account_type int, account_stages int, account_leverage int,"
        " trades_check int, contract_sign_staus int, reason string, created_at timestamp_ntz"
    ),
    "preferred_logins": "login string, purchase_id bigint",
    "account_data": "account_login string, main_password string, investor_password string",
    "account_stats": (
        "account_login string, `group` string, status int, current_equity double, yesterday_equity double,"
        " performance_percent double, current_overall_drawdown double, current_daily_drawdown double,"
        " average_win double, average_loss double, hit_ratio double, best_trade double, worst_trade double,"
        " max_consecutive_wins int, max_consecutive_losses int, trades_without_stoploss int,"
        " most_traded_asset string, win_coefficient double, avg_win_loss_coefficient double,"
        " best_worst_coefficient double, maximum_daily_drawdown double, maximum_overall_drawdown double,"
        " consistency_score double"
    ),
    "platform_events": (
        "id bigint, user_id bigint, login string, event string, created_at string, hourl_gap_status int"
    ),
    "breach_activities": (
        "Id bigint, account_login string, BreachCount int, LastBreachDate string, IsBreached int"
    ),
    "payout_requests": (
        "id bigint, user_id bigint, program_login string, type string, amount double, method string, status int,"
        " data string, compliance_note string, approved_by string, created_at timestamp_ntz,"
        " updated_at timestamp_ntz"
    ),
    "equity_daily": (
        "trading_account string, day string, created_date string, equity double, balance double,"
        " equity_eod_mt5 double"
    ),
    "deals": (
        "trading_account string, deal_id bigint, position_id bigint, deal_type int, profit double,"
        " deal_time string, deal_entry int, deal_price double, deal_symbol string, deal_stoploss double,"
        " deal_volume double, deal_commission double, dupe_detected int, deal_swap double"
    ),
    "default_settings": (
        "uuid string, "
        + ", ".join(f"`{c}` boolean" for c in _SETTING_FLAGS)
        + ", "
        + ", ".join(f"`{c}` int, `{c}_unit` string" for c in _SETTING_SPANS)
        + ", breach_type string, max_open_lots double, max_risk_per_symbol double, max_trading_days int,"
        " min_trading_days int, account_leverage int, profit_split double, profit_target double,"
        " max_drawdown double, max_daily_drawdown double, created_by string, updated_by string"
    ),
    "role_permissions": "role_uuid string",
}

# Columns of each target table, in order.
TARGETS: dict[str, list[str]] = {
    "users": (
        "uuid ref_by_user_id ref_link_count email password first_name last_name phone phone_verified"
        " sent_activation_mail_count status reset_pass_hash address country state city zip timezone"
        " google_app_secret 2fa_sms_enabled identity_status identity_verified_at affiliate_terms"
        " dashboard_popup discord_connected used_free_count available_count trail_verification_status"
        " last_login_at created_at updated_at is_google_app_verify dob role_id accept_affiliate_terms"
        " deleted_at ref_code"
    ).split(),
    "discount_codes": (
        "uuid name code max_usage_count current_usage_count discount start_date end_date challenge_amount"
        " challenge_step email created_by created_at updated_at type commission_percentage deleted_at status"
    ).split(),
    "purchases": (
        "uuid user_uuid amount_total currency payment_method payment_status is_paid_aff_commission user_data"
        " original_amount discount_uuid already_paid payment_transaction_id payment_response"
        " payment_attempt_count created_at updated_at webhook_response purchase_type competition_uuid ip"
    ).split(),
    "platform_accounts": (
        "uuid user_uuid purchase_uuid platform_login_id platform_name remote_group_name platform_group_uuid"
        " current_phase main_password investor_password initial_balance profit_target profit_split max_drawdown"
        " max_daily_drawdown account_stage account_type account_leverage status funded_at is_kyc is_trades_check"
        " is_trade_agreement reason deleted_at created_at updated_at action_type funded_status platform_user_id"
    ).split(),
    "account_stats": (
        "uuid status current_equity yesterday_equity performance_percent current_overall_drawdown"
        " current_daily_drawdown average_win average_loss hit_ratio best_trade worst_trade max_consecutive_wins"
        " max_consecutive_losses trades_without_stoploss most_traded_asset win_coefficient"
        " avg_win_loss_coefficient best_worst_coefficient maximum_daily_drawdown maximum_overall_drawdown"
        " consistency_score lowest_watermark highest_watermark current_balance current_profit"
        " platform_group_uuid platform_account_uuid trading_days_count first_trade_date total_trade_count"
    ).split(),
    "platform_events": "uuid user_uuid event created_at updated_at reason platform_account_uuid".split(),
    "breach_activities": "id breach_count last_breach_date is_breached platform_account_uuid".split(),
    "payout_requests": (
        "uuid user_uuid type amount method status data created_at updated_at platform_account_uuid payout_id"
        " note note_created_by"
    ).split(),
    "equity_daily": "id day created_date equity balance equity_eod_mt5 platform_account_uuid".split(),
    "deals": (
        "id deal_id position_id deal_type profit deal_time deal_entry deal_price deal_symbol deal_stoploss"
        " deal_volume deal_commission dupe_detected deal_swap platform_account_uuid"
    ).split(),
    "challenge_settings": (
        "uuid 100_profit_split 2_percent_lower_target 2_percent_more_daily_drawdown"
        " 2_percent_more_max_drawdown allow_expert_advisors breach_type close_all_positions_on_friday"
        " delete_account_after_failure delete_account_after_failure_unit double_leverage held_over_the_weekend"
        " inactivity_breach_trigger inactivity_breach_trigger_unit max_open_lots max_risk_per_symbol"
        " max_time_per_evaluation_phase max_time_per_evaluation_phase_unit max_time_per_funded_phase"
        " max_time_per_funded_phase_unit max_trading_days min_time_per_phase min_time_per_phase_unit"
        " no_sl_required requires_stop_loss requires_take_profit time_between_withdrawals"
        " time_between_withdrawals_unit visible_on_leaderboard withdraw_within withdraw_within_unit"
        " platform_group_uuid platform_account_uuid created_at updated_at account_leverage profit_split"
        " profit_target max_drawdown max_daily_drawdown min_trading_days"
    ).split(),
}


def source_schema(name: str) -> T.StructType:
    """Schema of a source table; needs an active session."""
    return T.StructType.fromDDL(SOURCES[name])
